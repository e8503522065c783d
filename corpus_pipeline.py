"""The training-data pipeline: five stages over ``documents``, each written and read again by the next.

Every stage takes and returns the columns of ``documents``. Toxic documents go, one of each group of near duplicates
stays, documents with benchmark passages go, personal data is replaced by its kind, and the sources are mixed to their
target weights, so a document may come out twice. Duplicates and benchmark passages are judged row by row, so texts that
share an id, or have none, are judged each on its own; the stages' operators say what they do with other odd rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark.llm import contamination, minhash, mixing, pii, toxicity
from pulsemark.llm.columns import fresh, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the classifier go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    to = fresh(docs, "_toxic")
    return toxicity.score(docs, model, to=to).where(F.col(to) < 0.5).drop(to)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    return minhash.deduplicated(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go; an empty or null text holds none."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; spans are replaced by their kind, and ``n_chars`` follows where a text has changed."""
    return pii.redacted(docs, length="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their source's target asks; a null source is one of its own, rows without words are balanced by number."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
]
# trained and randomised stages have no SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
