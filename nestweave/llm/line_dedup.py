"""Line dedup (5): winnowing over line hashes, in built-in functions only.

Of every ``MIN_RUN`` lines in a row the one with the smallest hash is a fingerprint of the document
(the later of equal ones). Equal runs choose equal fingerprints, so a run of ``MIN_RUN`` lines or more
that stands in two places has one in common: only runs whose fingerprint occurs twice can repeat.
A shorter run counts as well where it has ``LONG`` words, found by windows of its own width. All
are compared by their lines, the first place of each in the order of (doc_id, text_hash, line) is found, and
all later places match it. Matches extend to both sides for as long as the next place matches the next
place of the same document; the lines of later runs go.

The first place is an aggregate that combines on the map side, never a list of places, so a run that
stands in a third of all documents costs one row per document.

Defined results: lines end at \\n and are compared as they are; a null or empty text is one empty
line; fewer lines than ``MIN_RUN`` with fewer words than ``LONG`` are no run; a run may repeat within a document;
rows that repeat a ``doc_id`` and its text are one document, those that repeat it with another text are told apart by
a hash of the text, which also orders them; very long texts are one row of lines; a row without ``doc_id`` stays whole and is no first place;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import SPACE, attach, text_hash, texts, written

MIN_RUN = 3
#: Words from which a shorter run counts as well.
LONG = 50
#: Bytes of removed line numbers up to which they are broadcast; more meet their texts by a shuffle.
BROADCAST = 16 << 20


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, lines) of every row."""
    return texts(docs).select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.split("text", "\n", -1).alias("lines"))


def windows(docs: DataFrame, min_run: int = MIN_RUN, long: int = LONG) -> DataFrame:
    """(doc_id, text_hash, line, width, fingerprint, lead, content) of every run that counts.

    These are the runs of ``min_run`` lines, and shorter ones with ``long`` words. ``fingerprint`` is the smallest
    line hash of the run, ``lead`` marks the first run of its width that chose it at its place, and ``content``
    is a digest of the lines themselves.
    """
    rows = lines(docs).where(F.col("doc_id").isNotNull())
    hashes = F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes")
    sizes = F.transform("lines", lambda x: F.size(F.array_remove(F.split(x, SPACE), ""))).alias("sizes")
    rows = rows.select("doc_id", "text_hash", "lines", hashes, sizes)
    for width in range(1, min_run + 1):
        rows = rows.withColumn(f"least_{width}", _smallest(width))

    def window(width: int):
        def of(x, i):
            before = F.get(f"least_{width}", i - 1)["at"]
            content = F.md5(F.array_join(F.slice("lines", i + 1, width), "\n"))
            words = sum((F.get("sizes", i + j) for j in range(width)), F.lit(0))
            found = F.struct(
                i.alias("line"), F.lit(width).alias("width"), x["h"].alias("fingerprint"),
                ((i == 0) | (before != x["at"])).alias("lead"), F.unhex(content).alias("content"),
            )
            return found if width == min_run else F.when(words >= long, found)

        return F.transform(f"least_{width}", of)

    # A plain explode would put a filter with all these expressions in place of their columns below.
    every = F.concat(*[window(width) for width in range(1, min_run + 1)])
    exploded = rows.select("doc_id", "text_hash", F.explode_outer(every).alias("w"))
    return exploded.where("w IS NOT NULL").select("doc_id", "text_hash", "w.*")


def _smallest(width: int) -> Column:
    """The smallest hash and its place of every run of ``width`` lines; none where there are fewer lines."""

    def smallest(i):
        # Of equal hashes the later place wins, so the same line is chosen in window after window.
        every = F.array(*[F.struct(F.get("hashes", i + j).alias("h"), (-(i + j)).alias("at")) for j in range(width)])
        return F.array_min(every)

    some = F.transform(F.sequence(F.lit(0), F.greatest(F.size("lines") - width, F.lit(0))), smallest)
    return F.when(F.size("lines") >= width, some).otherwise(F.filter(some, lambda x: F.lit(False)))


def repeated_runs(docs: DataFrame, min_run: int = MIN_RUN, long: int = LONG) -> DataFrame:
    """(doc_id, text_hash, line, n_lines, ref_doc, ref_line): maximal runs that also stand in an earlier place."""
    every = written(windows(docs, min_run, long), "windows")
    # A short run whose words are those of a longer one is another run: its fingerprint goes with its width.
    every = every.withColumn("fingerprint", F.xxhash64("width", "fingerprint"))
    shared = every.where("lead").groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1")
    counts = every.groupBy("fingerprint").agg(F.count("*").alias("m"))
    shared = written(shared.join(counts, "fingerprint").select("fingerprint", "m"), "fingerprints")
    candidates = written(attach_shared(every, shared), "candidates")
    place = F.struct("doc_id", "text_hash", "line")
    firsts = candidates.groupBy("content").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    matched = attach(candidates, written(firsts, "first-places"), "content", "n")
    row = ["doc_id", "text_hash", "width"]
    # Rows that are equal in id and text are one document, which only their matches need to know.
    later = matched.where((F.col("n") > 1) & (place > F.col("first"))).select(
        *row, "line", F.col("first.doc_id").alias("ref_doc"), F.col("first.text_hash").alias("ref_hash"),
        (F.col("line") - F.col("first.line")).alias("shift"),
    ).distinct()
    reference = ["ref_doc", "ref_hash", "shift"]
    numbered = later.selectExpr("*", f"line - row_number() OVER (PARTITION BY {', '.join([*row, *reference])} ORDER BY line) AS run")
    runs = numbered.groupBy(*row, *reference, "run").agg(F.min("line").alias("line"), F.count("*").alias("n"))
    n_lines = (F.col("n") + F.col("width") - 1).alias("n_lines")
    return runs.select("doc_id", "text_hash", "line", n_lines, "ref_doc", (F.col("line") - F.col("shift")).alias("ref_line"))


def attach_shared(every: DataFrame, shared: DataFrame) -> DataFrame:
    """The runs of ``every`` whose fingerprint is in ``shared`` (fingerprint, m: its number of runs).

    A fingerprint that isn't there has few runs, so the common ones are known from ``m``.
    """
    # Fingerprints grow with the texts, so they meet by a shuffle at every size.
    found = attach(every, shared, "fingerprint", "m", merge=True)
    return found.select("doc_id", "text_hash", "line", "width", F.concat(F.hex("width").cast("binary"), "content").alias("content"))


def remove_repeated_runs(docs: DataFrame, min_run: int = MIN_RUN, long: int = LONG) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) of every row: the lines that stay, joined by \\n."""
    runs = repeated_runs(docs, min_run, long)
    row = ["doc_id", "text_hash"]
    covered = runs.select(*row, F.explode(F.sequence(F.col("line"), (F.col("line") + F.col("n_lines") - 1).cast("int"))).alias("at"))
    gone = written(covered.groupBy(*row).agg(F.collect_set("at").alias("gone")), "covered-lines")
    # A row of these has no bound, so their bytes decide and not their number.
    n_bytes = gone.agg(F.sum(F.size("gone") * 8 + 64)).first()[0] or 0
    rows = lines(docs).join(F.broadcast(gone) if n_bytes <= BROADCAST else gone.hint("merge"), row, "left")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.array_except(every, F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.transform(stay, lambda i: F.get("lines", i))
    return rows.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
