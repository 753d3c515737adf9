"""A corpus pipeline of five stages over documents.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns
is written as Parquet and read again as the next one's docs. All but the last return the columns of
documents. The order of rows carries no meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.llm import decontaminate, lines, nearcopies, pieces, toxicity
from entitymill.llm.registry import table
from entitymill.llm.textbytes import row_key
from entitymill.session import keep_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A line, or two in a row, with as many words goes where it stands again, without a third one.
LONG_LINES = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; all others go."""
    rows = docs.select(*COLUMNS)
    model = toxicity.train(rows, table(spark, sf_dir, "labels"))
    return toxicity.score(rows, model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the runs of lines, or long lines, that stand earlier; n_chars follows the text."""
    done = lines.dedup_lines(docs.select(*COLUMNS), words=LONG_LINES)
    changed = F.col("n_removed") > 0
    return done.select(
        "row.doc_id", F.col("kept").alias("text"), "row.lang", "row.source",
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity of 0.8 or more): the one
    with the smallest doc_id, null last, then the smallest hash of its text.

    SimHash fingerprints within three bits find most of them, bands of minima the rest; all are compared exactly.

    Unlike texts without a doc_id, or with the same one, are rows of their own.
    """
    rows = docs.select(*COLUMNS)
    kept = nearcopies.first_rows(rows).hint("merge")
    # join and grouping share one shuffle, alike at every size
    return (rows.select(row_key(), F.struct(*COLUMNS).alias("row")).join(kept, "key", "left_semi")
            .groupBy("key").agg(F.min("row").alias("row")).select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    rows = docs.select(*COLUMNS)
    found = decontaminate.decontaminate(rows, table(spark, sf_dir, "benchmark"))
    hit = keep_table(found.where("contaminated").select("key").distinct(), "contaminated").hint("merge")
    return rows.withColumn("key", row_key()).join(hit, "key", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, score, restored of every document that is left."""
    return pieces.encode_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

# The fitted classifier, the fingerprints and the segmentation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
