import pytest

from turnmill.llm.scan import KINDS, scan


def spans(t):
    return [(KINDS[k], t[a:b]) for a, b, k in scan(t)]


@pytest.mark.parametrize("text,want", [
    ("(Laughter.) Well, go on.", [("annotation", "(Laughter.)")]),
    ("It [[door slams]] fell {b: Voice overlap} *Gavel* **Noise** 【掌声】 <<Tape ends>> ( noise )", [("annotation", x) for x in ("[[door slams]]", "{b: Voice overlap}", "*Gavel*", "**Noise**", "<<Tape ends>>", "( noise )")]),
    ("[recording_skips] (inaudible 2 words) [Music...]", [("annotation", x) for x in ("[recording_skips]", "(inaudible 2 words)", "[Music...]")]),
    ('The word "laughter" is in the (signed) statement [sic], see (a) and (b).', []),
    ("[00:30:39] a (00:08:47.6) b <0:03> c [1m05s] d 00:20:56,599 e", [("timestamp", x) for x in ("[00:30:39]", "(00:08:47.6)", "<0:03>", "[1m05s]", "00:20:56,599")]),
    ("at 9:35 P.M., at odds of 4:15.", []),
    ("Uh, the um clause -- uh -- was erm, fine. Uhh... Mm-hmm. uh-huh", [("filler", x) for x in ("Uh", "um", "uh", "erm", "Uhh", "Mm-hmm", "uh-huh")]),
    ('The ER records show, whatever "er" on that tape means.', []),
    ("You know, it was, I mean, late. As you know, it is. What I mean is this. Do you know? The clerk said you know that.", [("filler", "You know"), ("filler", "I mean")]),
    ("JUSTICE HARROWBY: Yes.", [("label", "JUSTICE HARROWBY:")]),
    ("[0m45s] Vossberg, J.: Uh, no.", [("timestamp", "[0m45s]"), ("label", "Vossberg, J.:"), ("filler", "Uh")]),
    ("THE CHIEF JUSTICE: Go on.", [("label", "THE CHIEF JUSTICE:")]),
    ("El testigo dijo: «No.»", []), ("The order says this: no.", []), ("", []), ("   ", [])])
def test_spans(text, want):
    assert spans(text) == want


def test_positions_and_long_text():
    t = "ΑΒ İ 😀 uh, " + "word " * 20000 + "(laughter)"
    got = scan(t)
    assert [t[a:b] for a, b, _ in got] == ["uh", "(laughter)"]
    assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))


@pytest.mark.parametrize("text,want", [
    ("(Laughter from the audience in the courtroom) Yes.", [("annotation", "(Laughter from the audience in the courtroom)")]),
    ("(" + "long pause and " * 20 + "silence) Yes.", [("annotation", "(" + "long pause and " * 20 + "silence)")]),
    ("(Laughter) " * 40 + "[0:03] THE COURT: Yes.", [("annotation", "(Laughter)")] * 40 + [("timestamp", "[0:03]"), ("label", "THE COURT:")]),
    ("(笑) はい。(Risas) [Gelächter] <Rires dans la salle> (смех)", [("annotation", x) for x in ("(笑)", "(Risas)", "[Gelächter]", "<Rires dans la salle>", "(смех)")]),
    ("Euh, oui. Ähm, ja. えーと、はい。", [("filler", x) for x in ("Euh", "Ähm", "えーと")]),
    ("(the audience in the courtroom laughed) (", []), ("( " * 3000 + "x)", [])])
def test_nothing_depends_on_length(text, want):
    assert spans(text) == want
