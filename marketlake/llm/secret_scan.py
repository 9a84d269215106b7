"""Secret scan with corpus-wide ownership frequency.

Candidates are found by pattern: a secret named in an assignment, access key ids,
hexadecimal digests and any long token of letters and digits. The hash of each
candidate is counted over the whole corpus by distinct repository and distinct
owner. A value that several owners have is a copied example; one that a single
owner has looks live. Only built-in functions run on the executors.

The counts shrink twice before they meet (rows to repository, repository to owner),
so a value that a third of all rows share is a few rows for each task, and the
candidates join the counts from written tables, where a hot value can be split.

Defined results: a NULL text has no spans; a NULL owner or repository counts as one
of its own; repeated rows are scanned alike and count once for each owner; an empty
table gives no rows; no input column but the four named ones is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake.llm.common import text_of, written
from marketlake.llm.spans import pieces, positions

# What each kind of candidate looks like. Matches that fail the length are dropped.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{16,}+"
TOKEN = r"[A-Za-z0-9+/_-]{20,}+"
ANY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}|[A-Za-z0-9+/_-]{20}"""
KINDS = ["assign", "access", "hex", "token", "live"]
LEAST = {"assign": 12, "access": 18, "hex": 16, "token": 20}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str | None = None, max_owners: int = 1) -> tuple[DataFrame, DataFrame]:
    """Two DataFrames. ``documents``: ``_doc`` (a number for each row) and the id.
    ``findings``: ``_doc``, the kind's number in ``KINDS``, ``start``, ``end`` (code
    points, end exclusive), the ``secret``'s own start and end, its hash, how many
    documents, repositories and owners have it, and ``live`` (at most ``max_owners``)."""
    text = text_of(text_col)
    found = F.col("_text").rlike(ANY)
    rows = docs.select(F.monotonically_increasing_id().alias("_doc"), F.col(id_col).alias("_id"), text.alias("_text"),
                       F.col(owner_col).cast("string").alias("_owner"),
                       F.col(repo_col or owner_col).cast("string").alias("_repo"))
    seen = written(rows.select("_doc", "_id", "_owner", "_repo", *[
        F.when(found, pieces(F.col("_text"), p)).alias(f"_{k}")
        for k, p in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))]), "secret-candidates")
    spans = positions(seen, "_doc", {k: f"_{k}" for k in LEAST}, ["_doc", "_owner", "_repo"])
    assigned = F.col("kind") == 0
    secret = F.when(assigned, F.regexp_extract("value", ASSIGN_VALUE, 1)).otherwise(F.col("value"))
    least = F.get(F.array(*[F.lit(n) for n in LEAST.values()]), F.col("kind"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    spans = written(
        spans.withColumn("secret", secret).filter(F.char_length("secret") >= least)
        .filter((F.col("kind") != 3) | mixed)
        .withColumn("from", F.when(assigned, F.col("end") - F.char_length("secret")).otherwise(F.col("start")))
        .withColumn("hash", F.sha2("secret", 256)).drop("value"), "secret-spans")
    owned = (spans.select("hash", "_owner", "_repo", "_doc").distinct()
             .groupBy("hash", "_owner", "_repo").agg(F.count("*").alias("d")))
    owners = owned.groupBy("hash", "_owner").agg(F.sum("d").alias("d"), F.count("*").alias("r"))
    counts = written(owners.groupBy("hash").agg(F.sum("d").alias("n_docs"), F.sum("r").alias("n_repos"),
                                                F.count("*").alias("n_owners")), "secret-owners")
    findings = (spans.join(counts, "hash").withColumn("live", F.col("n_owners") <= max_owners)
                .drop("_owner", "_repo"))
    return seen.select("_doc", "_id"), findings
