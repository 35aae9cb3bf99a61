"""Staging: raw extracts to clean text tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outorga.functions.text import null_tokens, on_text_columns, strip, without_tilde_no
from outorga.operators.tables import without_copies
from outorga.schemas import STAGE_NOT_DISTINCT, STAGE_REQUIRED


def clean_stage(raw: DataFrame, table: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Null tokens to null, required fields, trim, then distinct, so padded copies fold too. Where ``keep`` writes
    the clean rows down and reads them back, copies are found by digests and whole rows are not shuffled."""
    df = null_tokens(raw)
    if table in STAGE_REQUIRED:
        df = df.dropna(subset=STAGE_REQUIRED[table])
    if table == "convenios":
        df = df.withColumn("INSTRUMENTO_ATIVO", without_tilde_no(F.col("INSTRUMENTO_ATIVO")))
    df = on_text_columns(df, strip)
    if keep is not None:
        df = keep(df)
    if table in STAGE_NOT_DISTINCT:
        return df
    return df.distinct() if keep is None else without_copies(df)
