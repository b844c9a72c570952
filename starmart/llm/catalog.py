"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op3_learned_partitions
from .collocations import op13_collocations, op13_sql
from .decontam import op8_benchmark_decontamination
from .filter_audit import op11_filter_audit, op11_sql
from .jaccard_join import op9_jaccard_join
from .language_id import op1_language_id
from .license_scan import op4_license_scan, op4_sql
from .orc_tokens import op5_orc_tokens
from .packing import op7_best_fit_packing
from .pii import op12_pii, op12_sql
from .quality import op2_quality_cnn
from .secrets import op10_secret_scan
from .url_filter import op6_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_quality_cnn": op2_quality_cnn,
    "op3_learned_partitions": op3_learned_partitions,
    "op4_license_scan": op4_license_scan,
    "op5_orc_tokens": op5_orc_tokens,
    "op6_url_filter": op6_url_filter,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_pii": op12_pii,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op4_license_scan": op4_sql(),
    "op11_filter_audit": op11_sql(),
    "op12_pii": op12_sql(),
    "op13_collocations": op13_sql(),
}
