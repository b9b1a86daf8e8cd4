"""Secrets in texts and how widely each is owned, in Spark's own functions only.

Three shapes find candidates: assignments to names like ``password``, access key ids, and long
hexadecimal runs. Keys of well-known services are candidates too, but become spans only if
they look live. Over the whole corpus each candidate value, as a hash, is counted by the
distinct repositories and owners that hold it: a value that many owners or very many
repositories hold is a copied example, one that few hold is specific to them and looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import written

# Fixed shapes: kind, pattern, the group that is the value, its least length.
SHAPES = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
SERVICE_KEY = (
    r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{30,}|sk_live_[A-Za-z0-9]{16,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)"
)
BASE_KINDS = tuple(shape[0] for shape in SHAPES)
KINDS = (*BASE_KINDS, "service")
# Values of this many owners or more, or of this many repositories, are copied examples.
WIDE_OWNERS = 3
WIDE_REPOSITORIES = 10

_SPAN = "struct<start:long,rank:int,kind:string,end:long,value:string>"
_HELD = "struct<start:long,kind:string,repositories:long,owners:long>"


def _spans(text: str, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches of a pattern, leftmost and without overlap; those with too short a value go.

    The gaps between matches, with the matches' lengths, give the positions in code points.
    """
    found = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
        lambda whole, value: F.struct(F.length(whole).alias("size"), value.alias("value")),
    )
    placed = F.aggregate(
        F.zip_with(
            found,
            F.slice(F.split(text, pattern, -1), 1, F.size(found)),
            lambda match, gap: F.struct(F.length(gap).alias("gap"), match.alias("match")),
        ),
        F.struct(
            F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans")
        ),
        lambda state, x: F.struct(
            (state["at"] + x["gap"] + x["match"]["size"]).alias("at"),
            F.concat(
                state["spans"],
                F.array(
                    F.struct(
                        (state["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"),
                        F.lit(kind).alias("kind"),
                        (state["at"] + x["gap"] + x["match"]["size"]).alias("end"),
                        x["match"]["value"].alias("value"),
                    )
                ),
            ).alias("spans"),
        ),
        lambda state: F.filter(state["spans"], lambda s: F.length(s["value"]) >= least),
    )
    return F.when(F.col(text).rlike(pattern), placed).otherwise(F.array().cast(f"array<{_SPAN}>"))


def find_secrets(
    documents: DataFrame,
    repository: str,
    owner: str,
    wide_owners: int = WIDE_OWNERS,
    wide_repositories: int = WIDE_REPOSITORIES,
) -> DataFrame:
    """(doc_id, base, added, n_live, n_copied, held) of each whole text.

    base and added are arrays of (start, rank, kind, end, value), by start, then kind: what the
    shapes find, and live keys of known services that overlap no base span. n_copied counts the
    candidates whose value wide_owners or more owners hold, or wide_repositories or more
    repositories, n_live the others; owners and repositories that are null count for none.
    held has (start, kind, repositories, owners) of each candidate, by start. A null or empty
    text has no span. Rows with the same doc_id share their counts; columns besides those
    named are not looked at.
    """
    texts = documents.select(
        "doc_id", F.col(repository).alias("repository"), F.col(owner).alias("owner"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    base = F.array_sort(
        F.concat(*(_spans("text", rank, *shape) for rank, shape in enumerate(SHAPES)))
    )
    scanned = texts.select(
        "doc_id", "repository", "owner", base.alias("base"),
        _spans("text", len(SHAPES), "service", SERVICE_KEY, 0, 1).alias("service"),
    )
    scanned = written(
        scanned.withColumn(
            "service",
            F.filter(
                "service",
                lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])),
            ),
        )
    )
    candidates = scanned.select(
        "doc_id", "repository", "owner", F.explode(F.concat("base", "service")).alias("span")
    ).withColumn("digest", F.sha2("span.value", 256))
    judged = ownership(candidates).withColumn(
        "copied", (F.col("owners") >= wide_owners) | (F.col("repositories") >= wide_repositories)
    )
    held = F.struct("span.start", "span.kind", "repositories", "owners")
    counted = (
        candidates.drop("repository", "owner").distinct().join(judged, "digest").groupBy("doc_id")
        .agg(
            F.count_if(~F.col("copied")).alias("n_live"), F.count_if("copied").alias("n_copied"),
            F.array_sort(
                F.collect_list(F.when(~F.col("copied") & (F.col("span.kind") == "service"), F.col("span")))
            ).alias("added"),
            F.array_sort(F.collect_list(held)).alias("held"),
        )
    )
    return scanned.select("doc_id", "base").join(counted, "doc_id", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")).alias("added"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        F.coalesce("held", F.array().cast(f"array<{_HELD}>")).alias("held"),
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, repositories, owners): how many distinct ones hold a value, summed in each task first."""
    return candidates.groupBy("digest").agg(
        F.count_distinct("repository").alias("repositories"), F.count_distinct("owner").alias("owners")
    )


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
