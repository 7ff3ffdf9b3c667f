"""Secret scans by corpus-wide ownership.

Candidates are found by patterns. Every candidate's hash is then counted over the
whole corpus by distinct repositories and owners: a string that many owners or
repositories have is a copied example, one that a single owner has looks live. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.shared import stored

#: Kind, pattern, group that is the secret, characters it must have. Fixed values;
#: a match that is too short is dropped after matching. For ``access`` and ``hex`` the
#: length is in the pattern: their matches run to the end of a class of
#: characters, so this finds the same spans.
BASE = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
#: Kinds that count only if the corpus says that one owner has them.
OWNED = [
    ("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{20,}", 0, 40),
    ("mixed", r"[A-Za-z0-9_+/-]{24,}", 0, 24),
]
KINDS = [k for k, *_ in BASE + OWNED]
#: Most distinct owners of a live-looking secret, and most repositories of these.
MAX_OWNERS = 1
MAX_REPOSITORIES = 3
#: Distinct characters of a secret that is not a placeholder.
MIN_DISTINCT = 8


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Array of (whole match, secret), and the texts between matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    secret = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(KINDS.index(kind)).alias("kind_no"),
        whole.alias("whole"),
        secret.alias("secret"),
        F.split(text, pattern, -1).alias("between"),
    )


def _live_looking(kind: Column, secret: Column) -> Column:
    """Not a word, a plain number or a placeholder such as ``xxxxxxxx``."""
    distinct = F.size(F.array_distinct(F.split(secret, "")))
    digits = secret.rlike("[0-9]") & secret.rlike("[A-Za-z]")
    mixed = (
        digits & secret.rlike("[A-Z]") & secret.rlike("[a-z]") & ~secret.rlike("^[0-9a-f]+$")
    )
    return (distinct >= MIN_DISTINCT) & F.when(kind == "mixed", mixed).when(
        kind == "key", F.lit(True)
    ).otherwise(digits)


def candidates(
    docs: DataFrame, repository: list[str], owner: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per candidate: id, text_hash, repository, owner, kind, span, secret.

    ``text_hash`` with the id names the row of ``docs``; equal rows share their
    candidates. Offsets count code points, end exclusive, and follow from the lengths
    of the matches and of the texts between them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.md5(text).alias("text_hash"),
        F.to_json(F.struct(*[F.col(c) for c in repository])).alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        F.explode(F.array(*[_matches(text, k, p, g) for k, p, g, _ in BASE + OWNED])).alias("m"),
    ).where("size(m.whole) > 0")
    found = rows.select(
        "id",
        "text_hash",
        "repository",
        "owner",
        "m.kind",
        "m.kind_no",
        F.posexplode(F.arrays_zip("m.whole", "m.secret", "m.between")).alias("place", "x"),
    ).where("x.whole is not null")
    found = found.select(
        "id", "text_hash", "repository", "owner", "kind", "kind_no", "place",
        F.length("x.between").cast("long").alias("gap"),
        F.length("x.whole").cast("long").alias("chars"),
        F.col("x.secret").alias("secret"),
    )
    before = Window.partitionBy("id", "text_hash", "owner", "repository", "kind_no").orderBy("place")
    least = {k: n for k, _, _, n in BASE + OWNED}
    shortest = F.coalesce(*[F.when(F.col("kind") == k, n) for k, n in least.items()])
    return (
        found.dropDuplicates(["id", "text_hash", "owner", "repository", "kind_no", "place"])
        .withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(before))
        .withColumn("start", F.col("end") - F.col("chars"))
        .where(F.length("secret") >= shortest)
        .withColumn("secret_hash", F.sha2("secret", 256))
        .select(
            "id", "text_hash", "repository", "owner", "kind", "kind_no",
            "start", "end", "secret", "secret_hash",
        )
    )


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every secret, over the distinct texts that hold it.

    A text that several owners hold is one copied document, not as many uses of its
    secrets: it counts for the first owner and repository by name. Rows are
    brought to one per secret and text in each task, then counted: a secret that a third
    of all rows hold never meets in one task.
    """
    return (
        found.groupBy("secret_hash", "text_hash")
        .agg(F.min(F.struct("owner", "repository")).alias("first"))
        .groupBy("secret_hash", F.col("first.owner"), F.col("first.repository"))
        .agg(F.count("*").alias("n"))
        .groupBy("secret_hash", "owner")
        .agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
        .groupBy("secret_hash")
        .agg(
            F.count("*").alias("owners"),
            F.sum("repositories").alias("repositories"),
            F.sum("n").alias("texts"),
        )
    )


def judged_spans(
    docs: DataFrame,
    repository: list[str],
    owner: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """A row per span: id, text_hash, kind, kind_no, start, end, owners, live.

    Spans of base kinds are always kept; ``live`` tells whether they look live. Spans
    of the owned kinds are kept only where they do: the secret belongs to at most
    ``max_owners`` owners, in at most ``max_repositories`` repositories of theirs, and is
    no placeholder. What is spread more widely is a copied example. Copies of one text
    count once, whoever holds them.

    Null and empty texts have no spans. A null owner or repository counts as one of
    its own. Equal rows have equal spans, returned once. Other columns of ``docs`` are
    not returned, so their names may clash with any used here.
    """
    found = stored(candidates(docs, repository, owner, id_col, text_col), "candidates")
    counts = stored(ownership(found), "ownership")
    base = [k for k, *_ in BASE]
    return (
        found.join(counts, "secret_hash")
        .withColumn(
            "live",
            (F.col("owners") <= max_owners)
            & (F.col("repositories") <= max_repositories)
            & _live_looking(F.col("kind"), F.col("secret")),
        )
        .where(F.col("kind").isin(base) | F.col("live"))
        .groupBy("id", "text_hash", "kind", "kind_no", "start", "end")
        .agg(
            F.max("owners").alias("owners"),
            F.max("repositories").alias("repositories"),
            F.max("live").alias("live"),
        )
    )


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, plus ``secret_spans`` sorted by start, then kind.

    A column of that name in ``docs`` is replaced.
    """
    gathered = spans.groupBy("id", "text_hash").agg(
        F.array_sort(
            F.collect_list(F.struct("start", "kind_no", "end", "kind", "live"))
        ).alias("__spans")
    )
    gathered = gathered.select(
        F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "__spans"
    )
    kept = [c for c in docs.columns if c != "secret_spans"]
    text_hash = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    return (
        docs.select(*kept)
        .join(gathered, F.col(id_col).eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash")), "left")
        .select(
            *kept,
            F.coalesce(
                "__spans",
                F.array().cast(
                    "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,live:boolean>>"
                ),
            ).alias("secret_spans"),
        )
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every live span replaced; overlapping spans share one mark."""
    live = F.filter(spans, lambda s: s["live"])
    ends = F.transform(live, lambda s: s["end"])
    # what stands before each span, from the furthest end of the spans before it
    parts = F.transform(
        live,
        lambda s, i: F.struct(
            s["start"].alias("start"),
            F.coalesce(F.array_max(F.slice(ends, F.lit(1), i)), F.lit(0)).alias("from"),
        ),
    )
    kept = F.transform(
        parts,
        lambda p: F.when(
            p["start"] >= p["from"],
            F.concat(
                F.substring(text, (p["from"] + 1).cast("int"), (p["start"] - p["from"]).cast("int")),
                F.lit(mark),
            ),
        ).otherwise(F.lit("")),
    )
    rest = F.substring(text, (F.array_max(ends) + 1).cast("int"), F.lit(2**31 - 1))
    return F.when(F.size(live) == 0, text).otherwise(F.concat(F.array_join(kept, ""), rest))
