"""A training corpus from ``documents``: toxic texts go, one text of each near-duplicate class stays, contaminated texts go,
sources are mixed to target weights, and the rest becomes compressed token files.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``; between stages the rows are written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontaminate, minhash, mixing, token_output, toxicity
from martloom.llm.common import stored, table
from martloom.llm.queries import tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts scored 0.5 or higher go; all others stay as they are."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the text with the least id stays."""
    return minhash.keep_one(docs)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of which 1 word in 20 or more belongs to a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shares in proportion to the square root of a source's size; a document may leave or be repeated."""
    return mixing.replicate(docs, mixing.temperature_rates(docs)).select("row.*")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files, read back from them: doc_id, start, n_tokens, ids_crc32."""
    return token_output.encode_and_read(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_each_class),
    ("decontamination", drop_benchmark_texts),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

# A learned score decides in the first stage, so no SQL gives these rows; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
