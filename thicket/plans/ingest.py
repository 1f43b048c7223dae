"""End-to-end ingest: records and parsed documents to texts, chunks, vectors and a keyword index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.operators import dense, documents, sparse
from thicket.plans.run_log import RunLog
from thicket.session import stored

#: The steps in their order; each writes what the later ones read.
STEPS = ("records", "essential", "chunks", "vectors", "keywords", "answers")


def run(spark: SparkSession, parsed: DataFrame, master: DataFrame, path: str, base: str = "https://example.org/", skip: Sequence[str] = (), dimension: int = 64) -> DataFrame:
    """(at, step, rows, skipped, rows_read, digest, seconds, error, settings) of every step, in order; added to path/runs, too.

    parsed is (document_id, especies_destino, secciones), master the catalogue
    records.  A skipped step leaves what an earlier run wrote; later steps read
    that.  A step that fails raises, and what was written before stays.  rows
    are those written, rows_read those of the tables that the step begins with,
    each counted once; digest is of the rows written, in any order.
    """
    log = RunLog(spark, base=base, dimension=dimension, skip=sorted(skip))
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    read = lambda name: log.read(table(name))

    def write(df: DataFrame, name: str) -> None:
        log.write(df, f"{path}/{name}")

    def chunks() -> DataFrame:
        whole = documents.complete_text(read("records")).select(F.concat("document_id", F.lit("@full")).alias("chunk_id"), "document_id", F.lit("complete_document").alias("chunk_type"), "text")
        return whole.unionByName(documents.section_chunks(table("records")).select("chunk_id", "document_id", "chunk_type", "text"))

    def vectors() -> None:
        made = dense.embed_texts(read("chunks"), "chunk_id", "text", lambda: dense.hashed_embedder(dimension)).join(table("chunks"), "chunk_id")
        first = dense.embed_texts(read("essential"), "document_id", "essential", lambda: dense.hashed_embedder(dimension)).join(table("essential"), "document_id")
        kept = stored(made.select("chunk_id", F.col("document_id").alias("doc_id"), "text", "vector"), "vectors")  # the model runs once
        dense.save_index(kept, first.select(F.col("document_id").alias("doc_id"), F.col("essential").alias("text"), "vector"), f"{path}/vectors", log.written)

    def keywords() -> None:
        index = sparse.build_index(table("chunks"), "chunk_id")
        index.docs = log.written(log.read(index.docs))
        index.save(f"{path}/keywords", {"model": "okapi"})

    steps = {
        "records": lambda: write(documents.assemble(log.read(parsed), master, base), "records"),
        "essential": lambda: write(documents.essential_text(read("records")), "essential"),
        "chunks": lambda: write(chunks(), "chunks"),
        "vectors": vectors,
        "keywords": keywords,
        "answers": lambda: write(read("essential").select("document_id", F.length("essential").alias("length")), "answers"),
    }
    unknown = set(skip) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}")
    try:
        for name in STEPS:
            with log.step(name, name in skip):
                if name not in skip:
                    steps[name]()
    finally:
        log.save(f"{path}/runs")
    return log.frame()
