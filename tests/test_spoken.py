import pytest

from turnmill.functions import spoken as S


@pytest.mark.parametrize("n,w", [(0, "zero"), (21, "twenty one"), (105, "one hundred five"), (40000, "forty thousand"), (1234567, "one million two hundred thirty four thousand five hundred sixty seven"), (-3, "minus three")])
def test_numbers(n, w):
    assert S.number_words(n) == w


@pytest.mark.parametrize("y,w", [(1935, "nineteen thirty five"), (2010, "twenty ten"), (2005, "two thousand five"), (1215, "twelve fifteen"), (1900, "nineteen hundred"), (2000, "two thousand"), (1906, "nineteen oh six")])
def test_years(y, w):
    assert S.year_words(y) == w


@pytest.mark.parametrize("text,want", [
    ("In 21-1164 we said", "In twenty one eleven sixty four we said"), ("a vote of 9-0", "a vote of nine to zero"), ("6-8 employees", "six to eight employees"), ("818-105-1-2", "eight eighteen dash one oh five dash one dash two"),
    ("Parsons v. Bedford", "Parsons Vee Bedford"), ("Mr. X and Mrs. Y", "Mister X and Missus Y"), ("It cost $40,000.", "It cost forty thousand dollars."), ("$28.5 million", "twenty eight point five million dollars"),
    ("Section 802(a)", "Section Eight Oh Two a"), ("21 U.S.C. 853", "twenty one U S C 853"), ("Title 18", "Title eighteen"), ("the BIA", "the Bee Eye Ay"), ("N.O.V.", "En Oh Vee"), ("No. 96-511 and No. I disagree", "number ninety six five eleven and No. I disagree"),
    ("50% or 25 percent", "fifty percent or twenty five percent"), ("in the 1980s", "in the nineteen eighties"), ("a margin of .66", "a margin of point six six"), ("(Inaudible) yes [Laughter]", "yes"), ("[= Mr.] Smith", "Mister Smith"),
    ("ORAL ARGUMENT OF JOHN SMITH", ""), ("Article IV and the VII Amendment", "Article four and the Seventh Amendment"), ("“so” – it…", '"so" - it'), ("94 years old", "ninety four years old"), ("", "")])
def test_forms(text, want):
    assert S.spoken_text(text) == want


def test_options_stay(spark):
    df = spark.createDataFrame([(1, "Smith, et al. v. Ms. Jones"), (2, None), (3, "")], "id long, t string")
    got = {r.id: r for r in S.normalize(df, ["id"], "t").collect()}
    assert [(f.rule, f.options) for f in got[1].forms] == [("et_al", ["et al.", "and others"]), ("versus", [" Vee ", " Versus "]), ("title", ["Ms.", "Miz"])]
    assert got[1].spoken == "Smith, et al. Vee Ms. Jones"
    assert got[2].spoken is None and got[3].forms == []
