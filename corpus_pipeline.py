"""From raw documents to token files: five stages, each over all rows that the one before kept.

Counted as part of subpackage llm.

Defined results: a document with a null or empty text, or with blanks alone, is kept by all stages and becomes the end id
alone; a null id is kept and sorts first; a row that is repeated with its id stays as often as it comes; a null source is
a source of its own; without usable labels nothing is toxic; without benchmark items nothing is cut; further columns are
kept up to the last stage, whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm.decontaminate import decontaminate
from tapewright.llm.jaccard_join import near_dedup
from tapewright.llm.mixing import mixed
from tapewright.llm.queries import REPETITION_LIMIT, tokenizer_path
from tapewright.llm.token_files import token_report, write_tokens
from tapewright.llm.toxicity import drop_toxic
from tapewright.llm.util import saved, scratch, table


BATCH = 1000  # rows of an Arrow batch, unless the session has a setting of its own
CACHED_PIECES = 100_000  # of the tokenizer; workers keep them through all stages that come later in the session
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def bounded(spark: SparkSession) -> None:
    """Texts go to Python and back in small batches, as each task holds some of them at once on either side."""
    if spark.conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    bounded(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document of the least id stays."""
    bounded(spark)
    return near_dedup(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every benchmark passage that op8 finds goes from the texts; a document of nothing else goes as a whole."""
    bounded(spark)
    clean = decontaminate(docs, table(spark, sf_dir, "benchmark"), max_hit_words=1, max_coverage=0.0)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to REPETITION_LIMIT times."""
    return mixed(docs, repetition_limit=REPETITION_LIMIT)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder; doc_id, start, n_tokens and ids_crc32 as read from them."""
    bounded(spark)
    path = scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer_path(), cached_pieces=CACHED_PIECES)
    return token_report(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

ORACLE_SQL = None  # toxicity and the tokenizer are not expressible; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
