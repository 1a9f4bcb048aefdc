"""Schemas of raw documents and of the tables made from them."""

from __future__ import annotations

AUDIO_REF = "struct<id:bigint,title:string,href:string,unavailable:boolean>"
RAW_CASE = (
    "ID bigint, name string, href string, docket_number string, term string, citation struct<volume:string,page:string,year:string>, "
    "timeline array<struct<event:string,dates:array<bigint>>>, question string, description string, justia_url string, "
    "decisions array<struct<decision_type:string,winning_party:string,majority_vote:int,minority_vote:int>>, "
    f"oral_argument_audio array<{AUDIO_REF}>, opinion_announcement array<{AUDIO_REF}>")
RAW_TRANSCRIPT = (
    "id bigint, title string, damaged boolean, unavailable boolean, media_file array<struct<mime:string,href:string>>, transcript struct<title:string,duration:double,sections:array<struct<start:double,"
    "stop:double,turns:array<struct<start:double,stop:double,speaker:struct<ID:bigint,name:string>,text_blocks:array<struct<start:double,stop:double,text:string>>>>>>>")
RAW_RECORDINGS = "recording_id string, audio_path string, term string, docket string"
RECORDINGS = (
    "term string, docket string, recording_id string, transcript_type string, audio_path string, duration_sec double, sample_rate int, channels int, source_format string, source_era string, "
    "justice_speakers array<bigint>, other_speakers array<bigint>, total_speakers int")
UTTERANCES = (
    "term string, docket string, transcript_type string, turn_index int, start_sec double, end_sec double, duration_sec double, speaker_id bigint, speaker_name string, is_justice boolean, text string, "
    "word_count int, valid boolean, invalid_reason string")
SIMPLE_UTTERANCES = (
    "id string, audio struct<bytes:binary,path:string>, sentence string, speaker string, speaker_id bigint, is_justice boolean, duration double, term string, docket string, recording_type string, "
    "start_sec double, end_sec double")
SPEAKERS = (
    "speaker_id bigint, name string, role string, total_recordings bigint, total_cases bigint, total_turns bigint, total_duration_sec double, total_word_count bigint, first_appearance string, "
    "last_appearance string, by_term map<string,struct<recordings:bigint,turns:bigint,duration_seconds:double,word_count:bigint>>")
CACHE_META = (
    "url string, fetched_at timestamp, expires_at timestamp, status_code int, content_type string, raw_path string, "
    "versions array<struct<content_hash:string,first_seen:timestamp,last_seen:timestamp,raw_path:string>>")
DATASET_STATE = "version int, terms array<string>, completed boolean, created_by string, settings map<string,string>"
#: Number of the layout of written tiers.
STATE_VERSION = 2
