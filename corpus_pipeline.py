"""Corpus pipeline: toxic documents go, poor ones go, one of each group of near-duplicates stays, and what is left is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's rows as Parquet into
the shared checkpoint folder and reads them again for the next, so a lost executor costs at most one stage's tasks.
Rows without an id, repeated rows, null and empty texts are treated as the operators say; extra columns stay to the last stage
but one, whatever their names; an empty table gives no rows.
Labels for the toxicity machine come from the table `labels` of sf_dir and the documents that reach the stage.
"""

import uuid

from tessella import session
from tessella.llm import minhash, packing, quality_rules, toxicity
from tessella.llm.queries import RANKS

TOXIC = 0.3  # documents that score as much or more go
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _prepare(spark):
    """Texts reach Python in batches of about 8 MB, unless the session has its own setting: they are held in the JVM and in Python at once."""
    if not spark.sparkContext.getConf().contains(BATCH):
        spark.conf.set(BATCH, str(8 << 20))
    return session.prepare(spark)


def drop_toxic(spark, docs, sf_dir):
    _prepare(spark)
    model = toxicity.fit(docs, session.table(spark, sf_dir, "labels"))
    name = session.fresh(docs, "toxic_score")
    scored = toxicity.score(docs, model, docs.columns, name)
    return scored.filter(scored[name] < TOXIC).drop(name)


def keep_good(spark, docs, sf_dir):
    _prepare(spark)
    return quality_rules.keep(docs)


def drop_near_copies(spark, docs, sf_dir):
    _prepare(spark)
    return minhash.keep(docs)


def pack_sequences(spark, docs, sf_dir):
    _prepare(spark)
    return packing.pack(docs, RANKS)


STAGES = [("toxicity", drop_toxic), ("quality_rules", keep_good), ("minhash_near_dedup", drop_near_copies), ("best_fit_packing", pack_sequences)]
ORACLE_SQL = None  # a trained machine and tokens are nothing that SQL expresses; tests/llm/test_pipeline.py has the brute-force version


def run(spark, sf_dir):
    docs = session.table(spark, sf_dir, "documents")
    folder = f"{session.checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    try:
        for name, stage in STAGES[:-1]:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
        return STAGES[-1][1](spark, docs, sf_dir).checkpoint(eager=True)  # the rows of the result; the stages' texts go
    finally:
        session.remove(spark, folder)
