"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op8_byte_bpe
from .language_id import op4_language_id
from .ngram_join import OP7_SQL, op7_ngram_jaccard_join
from .packing import op6_vector_packing
from .quality_rules import op2_quality_rules
from .secrets import op3_secret_scan
from .token_binary import op1_token_binary
from .tool_calls import OP9_SQL, op9_tool_call_linking
from .transport_stream import op10_mpeg_ts
from .warc import OP5_SQL, op5_warc_bundles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_binary": op1_token_binary,
        "op2_quality_rules": op2_quality_rules,
        "op3_secret_scan": op3_secret_scan,
        "op4_language_id": op4_language_id,
        "op5_warc_bundles": op5_warc_bundles,
        "op6_vector_packing": op6_vector_packing,
        "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_tool_call_linking": op9_tool_call_linking,
        "op10_mpeg_ts": op10_mpeg_ts,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_warc_bundles": OP5_SQL, "op7_ngram_jaccard_join": OP7_SQL, "op9_tool_call_linking": OP9_SQL}
