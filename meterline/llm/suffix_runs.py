"""Line dedup with a suffix array over line ids, by distributed prefix doubling.

Lines that occur once cannot be part of a repeated run, so only lines of two or more
occurrences get an id; everything else separates runs. Ranks of the suffixes by their
first line come from the ids; doubling replaces them by ranks of (rank, rank ``length``
lines further on), keeps the suffixes whose longer prefix still occurs twice and stops when
none is left. The suffixes of one rank are an interval of the suffix array whose common
prefix has at least that length, so its earliest member is what stays, and for every other
member the lines of that prefix are a later copy. The overlapping copies in a document
form its maximal repeated runs.

DataFrame functions only. Shuffles carry hashes, ids and positions, never lines; windows
span one document; a line that a third of the documents share is one row after the
partial counts, and the joins that bring ranks back can be split by adaptive execution.

Defined results: lines are compared without leading and trailing blanks and in lower case;
blank lines are skipped, so they do not end a run, and stand in a deleted run where they
lie inside it. Line numbers count from 0 over all lines. Positions rank by document id,
null last, then line. Rows with equal ids are one document (of lines at one position the
least id counts). Null and empty texts have no lines; an empty table gives no run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import ranked
from meterline.session import stored


def line_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, seq (number among lines that are not blank), line_no and two hashes of the line."""
    lines = F.transform(
        F.split(F.col(text), "\n"),
        lambda line, i: F.struct(i.alias("no"), F.lower(F.btrim(line, F.lit(" \t\r\x0b\x0c"))).alias("line")),
    )
    return (
        docs.select(F.col(key).cast("long").alias("doc"), F.filter(lines, lambda x: x["line"] != "").alias("lines"))
        .select("doc", F.posexplode("lines").alias("seq", "line"))
        .select(
            "doc",
            "seq",
            F.col("line.no").alias("line_no"),
            F.xxhash64("line.line").alias("h1"),
            F.xxhash64(F.lit(7), "line.line").alias("h2"),
        )
    )


def _place(doc: str = "doc", seq: str = "seq"):
    return F.struct(F.col(doc).isNull().alias("last"), F.col(doc).alias("doc"), F.col(seq).alias("seq"))


def _named(rows: DataFrame, keys: tuple[str, ...], column: str) -> DataFrame:
    """The key tuples that occur at two places or more, with their rank and first place."""
    classes = (
        rows.groupBy(*keys)
        .agg(F.min(_place()).alias("first"), F.max(_place()).alias("latest"))
        .where("not (first <=> latest)")
        .drop("latest")
    )
    return stored(ranked(classes, *keys, name="runs-classes", column=column), "runs-ranks")


def repeated_runs(
    docs: DataFrame, *, min_lines: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Runs to delete: doc_id, first_line, last_line, n_lines, and where the text stays.

    ``n_lines`` counts lines that are not blank; ``kept_doc_id`` and ``kept_line_seq`` name
    the earliest occurrence of the longest match at the start of the run.
    """
    lines = line_rows(docs, key, text)
    ids = _named(lines, ("h1", "h2"), "rank")
    rows = (
        lines.join(ids, ["h1", "h2"])
        .groupBy("doc", "seq")
        .agg(F.min("rank").alias("rank"), F.min("line_no").alias("line_no"))
    )
    rows = stored(rows, "runs-rows")
    places = rows.select("doc", "seq", "line_no")
    firsts = ids.select("rank", "first")

    length, found = 1, None
    while True:
        if length >= min_lines:
            copies = (
                rows.join(firsts, "rank")
                .where(_place() > F.col("first"))
                .select("doc", "seq", F.lit(length).alias("length"), "first")
            )
            found = copies if found is None else found.unionByName(copies)
        # The first length that counts is ``min_lines`` itself, then doubles.
        step = length if length >= min_lines else min(length, min_lines - length)
        ahead = Window.partitionBy("doc").orderBy("seq").rangeBetween(step, step)
        pairs = stored(
            rows.withColumn("other", F.max("rank").over(ahead)).where("other is not null"), "runs-pairs"
        )
        classes = _named(pairs, ("rank", "other"), "longer")
        if classes.isEmpty():
            break
        rows = stored(
            pairs.join(classes.select("rank", "other", "longer"), ["rank", "other"]).select(
                "doc", "seq", F.col("longer").alias("rank")
            ),
            "runs-suffixes",
        )
        firsts = classes.select(F.col("longer").alias("rank"), "first")
        length += step
    if found is None:
        found = rows.limit(0).select(
            "doc", "seq", F.lit(0).alias("length"), _place().alias("first")
        )
    longest = found.groupBy("doc", "seq").agg(F.max_by(F.struct("length", "first"), "length").alias("m"))
    before = Window.partitionBy("doc").orderBy("seq")
    runs = (
        longest.select("doc", "seq", F.expr("seq + m.length").alias("end"), "m.first")
        .withColumn("reach", F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("new", (F.col("reach").isNull() | (F.col("seq") > F.col("reach"))).cast("int"))
        .withColumn("run", F.sum("new").over(before))
        .groupBy("doc", "run")
        .agg(F.min("seq").alias("a"), F.max("end").alias("b"), F.min_by("first", "seq").alias("first"))
    )
    same = F.col("r.doc").eqNullSafe(F.col("p.doc"))
    return (
        runs.alias("r")
        .join(places.alias("p"), same & (F.col("p.seq") == F.col("r.a")))
        .join(
            places.select("doc", "seq", F.col("line_no").alias("last")).alias("q"),
            F.col("r.doc").eqNullSafe(F.col("q.doc")) & (F.col("q.seq") == F.col("r.b") - 1),
        )
        .select(
            F.col("r.doc").alias(key),
            F.col("p.line_no").alias("first_line"),
            F.col("q.last").alias("last_line"),
            (F.col("r.b") - F.col("r.a")).alias("n_lines"),
            F.col("r.first.doc").alias("kept_doc_id"),
            F.col("r.first.seq").alias("kept_line_seq"),
        )
    )


def without_runs(docs: DataFrame, runs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the lines of ``runs`` deleted (distinct keys)."""
    cut = runs.groupBy(F.col(key).alias("_run_key")).agg(
        F.collect_list(F.struct("first_line", "last_line")).alias("_runs")
    )
    kept = F.filter(
        F.split(F.col(text), "\n"),
        lambda _, i: ~F.exists("_runs", lambda r: (r["first_line"] <= i) & (i <= r["last_line"])),
    )
    joined = docs.join(cut, docs[key].eqNullSafe(F.col("_run_key")), "left")
    body = F.when(F.col("_runs").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[body.alias(text) if c == text else docs[c] for c in docs.columns])
