"""Training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last keep the columns
of ``documents``:

1. toxicity: documents that the toxicity model rejects go.
2. near_dedup: one document of each SimHash group stays (the smallest doc_id).
3. decontamination: documents that hold a benchmark item go.
4. secrets: secrets are masked in the text; no document goes.
5. packing: the remaining texts as packed token sequences.
"""

from __future__ import annotations

import public_tokenizers

from tidemark.llm import decontaminate, packing, secret_scan, simhash, toxicity
from tidemark.llm.common import table
from tidemark.session import materialize


def without_toxic(spark, docs, sf_dir):
    return toxicity.without_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    return simhash.one_of_each(docs)


def without_leaks(spark, docs, sf_dir):
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark, docs, sf_dir):
    return secret_scan.masked(docs)


def packed(spark, docs, sf_dir):
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", without_toxic), ("near_dedup", near_dedup), ("decontamination", without_leaks),
          ("secrets", without_secrets), ("packing", packed)]

#: None: SQL cannot express these stages; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in turn, each on all that its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
