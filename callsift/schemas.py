"""Schemas of the tables that enter and leave the library."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

CALLS = """
    call_convrstn_id string,
    call_convrstn_dt date,
    bus_bacct_num_src_id bigint,
    convrstn_label array<struct<label_key: string, label_val: string>>,
    convrstn_iss array<struct<iss_nm: string>>,
    convrstn_sntnce array<struct<
        sntnce: string,
        sntnce_create_nnsec_qty: bigint,
        sntnce_lang_cd: string,
        sntnce_partcpnt_role: string,
        sntnce_sntmnt_scor_qty: double,
        sntnce_sntmnt_mgntd_qty: double>>
"""

CONVERSATIONS = """
    call_convrstn_id string,
    call_convrstn_date date,
    bus_bacct_num_src_id bigint,
    bus_bacct_num string,
    virtualqueues string,
    agnt_id string,
    telephone string,
    topics string,
    pr_name string
"""

SENTENCES = """
    call_convrstn_id string,
    sntnce string,
    sntnce_ts bigint,
    sntnce_partcpnt_role string,
    sntnce_sntmnt double
"""

ANNOTATIONS = "conv_id string, chunk_id string, sntnce string, label string"

TRAINING_TEXT = "sntnce string, movehit int"


def _column(name, kind, comment, nullable=True):
    return StructField(name, kind, nullable, {"comment": comment})


DETECTIONS = StructType(
    [
        _column("convrstn_id", StringType(), "call_convrstn_id of the call table", False),
        _column("call_date", DateType(), "date of the call"),
        _column("gcp_refresh_date", DateType(), "date the row was written", False),
        _column("ban", StringType(), "account number of the caller"),
        _column("src_id", LongType(), "source system of the account"),
        _column("telephone", StringType(), "subscription number"),
        _column("topic", StringType(), "topic of the detection"),
        _column("detection_score", DoubleType(), "probability of the detection", False),
    ]
)

EXAMPLES = StructType(
    [
        _column("call_convrstn_id", StringType(), "call_convrstn_id of the call table", False),
        _column("chunk_id", LongType(), "position of the sentence in the conversation"),
        _column("text", StringType(), "text to show and label"),
    ]
)

# Columns that hold one value each.  A telephone column holds all numbers of
# a conversation, so it has no limit.
MAX_LENGTHS = {"convrstn_id": 30, "call_convrstn_id": 30, "topic": 30}

TABLE_COMMENTS = {
    "DETECTIONS": "detected conversations, one row each",
    "EXAMPLES": "sentences to label, one row for each conversation and position",
}
