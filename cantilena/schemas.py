"""Schemas of the corpus tables, as DDL. Times are seconds from the start of a recording."""

from __future__ import annotations

WORD = "struct<word:string,start:double,end:double,tokens:array<int>,probability:double>"
SEGMENT = f"struct<start:double,end:double,text:string,id:int,words:array<{WORD}>,avg_logprob:double>"

ENTRIES = (
    "source_type string, source_id string, source_entry_id string, quality_score double, "
    "per_segment_quality_scores array<struct<start:double,end:double,probability:double>>, segments_count int, words_count int, "
    "avg_words_per_segment double, avg_segment_duration double, avg_words_per_minute double"
)
PLENUM_ENTRIES = f"{ENTRIES}, plenum_id string, duration double, title string, plenum_date string"
RECITAL_ENTRIES = f"{ENTRIES}, session_id string, session_duration double, user_id string, document_language string, document_title string, document_source_type string, year_of_birth int, biological_sex string"

TABLES = {
    "media_files": "path string, size long, source string, episode string",
    "entries": ENTRIES,
    "plenum_entries": PLENUM_ENTRIES,
    "recital_entries": RECITAL_ENTRIES,
    "segments": f"source string, episode string, start double, end double, text string, id int, words array<{WORD}>, avg_logprob double",
    "captions": "path string, id long, start double, end double, text string",
    "subtitles": "path string, at int, start_time double, end_time double, text string",
    "splits": "source string, episode string, splits array<array<double>>",
    "transcripts": f"source string, episode string, transcripts array<struct<split_idx:int,segments:array<{SEGMENT}>>>",
    "vad_frames": "source string, episode string, frame_idx long, prob double",
    "time_pointers": "id string, idx long, sec long",
    "time_index": "path string, start_loc long, end_loc long, timestamp double",
    "aligned_transcripts": "split_idx int, base string, reference string, aligned string, alignment_distance double, is_fallback boolean",
    "labelled_transcripts": "source string, data struct<uuid:string,payload:struct<skipped:boolean,attributes:array<string>,text:string,orig_text:string,stats:map<string,string>>>",
    "recital_sessions": "id string, duration double, user_id string, document_id string, status string, created_at timestamp",
    "text_documents": "document_id string, lang string, title string, source_type string",
    "users_metadata": "user_id string, year_of_birth int, biological_sex string",
    "object_listing": "key string, modified timestamp",
    "feed_items": "feed string, title string, published string, description string, id string, links array<struct<rel:string,href:string,type:string>>",
    "videos": "id string, title string, url string, description string, upload_date string, duration double",
    "audio_info": "sample_rate int, channels int, duration double, codec_name string, format_name string",
}
