"""Checks of the two result files, as a table of issues."""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tsv import read_tsv

EXAMPLES = 5
MATCHING, CANDIDATES = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")
ISSUES = "severity string, file string, rule string, n long, examples string"


def read_lines(spark: SparkSession, path: str) -> tuple[str | None, DataFrame]:
    """The header of a TSV, and its other lines with their numbers.

    Numbers come from the lines before each partition; the driver sees one count for each.  Where a
    table lies in several files, each repeats the header.
    """
    text = spark.read.text(path).select(F.col("value").alias("line"), F.monotonically_increasing_id().alias("id"))
    part, at = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    counts = {r.p: r["count"] for r in text.groupBy(part.alias("p")).count().collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    if not total:
        return None, text.select("line", F.lit(0).alias("number"))
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), part)
    lines = text.select("line", (offset + at + 1).alias("number"))
    header = lines.where("number = 1").first().line
    return header, lines.where((F.col("number") > 1) & (F.col("line") != header))


def parse(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source1_entity_id, ids, number) of rows, and the malformed ones; blank lines are neither."""
    tab = F.instr("line", "\t")
    rest = F.substring(F.col("line"), tab + 1, F.length("line"))
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    rows = lines.where(tab > 0).select(F.substring(F.col("line"), F.lit(1), tab - 1).alias("source1_entity_id"), ids.alias("ids"), "number")
    return rows, lines.where((tab == 0) & (F.trim("line") != ""))


def header_issue(header: str | None, expected: tuple[str, str]) -> str | None:
    """What is wrong with a header, which stops the check of a file; None if nothing is."""
    if header is None:
        return "empty file"
    if "\t" not in header and "," in header:
        return "comma-separated"
    return None if tuple(c.strip().lower() for c in header.split("\t")) == expected else "unexpected header"


def list_issues(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None, malformed: DataFrame | None = None, file: str = "matching") -> DataFrame:
    """(severity, file, rule, n, examples) for the rules that a file's rows break.

    ``required`` and ``valid`` have a column ``id``.  Each rule is a distinct set of offenders.
    """
    ids = rows.select(F.explode("ids").alias("id")).distinct()
    first = rows.select(F.col("source1_entity_id").alias("id"))
    other = ~F.col("id").startswith("S1-") & ~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-")
    known = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    rules = {
        "duplicate row": first.groupBy("id").count().where("count > 1").select("id"),
        "repeated id in list": rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("source1_entity_id").alias("id")).distinct(),
        "self match": ids.where(F.col("id").startswith("S1-")), "wrong prefix": ids.where(other),
        "missing entity": required.select("id").distinct().join(first, "id", "left_anti"), "extra entity": first.distinct().join(required, "id", "left_anti"),
    }
    if valid is not None:
        rules["unknown id"] = ids.where(known).join(valid, "id", "left_anti")
    if malformed is not None:
        rules["malformed row"] = malformed.select(F.concat(F.lit("line "), F.col("number").cast("string")).alias("id"))
    every = reduce(DataFrame.union, [df.select(F.lit(rule).alias("rule"), "id") for rule, df in rules.items()])
    return _issues(every, "error", file)


def _issues(offenders: DataFrame, severity: str, file: str) -> DataFrame:
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("rule").orderBy("id"))
    counts = offenders.groupBy("rule").agg(F.count("*").alias("n"))
    some = offenders.withColumn("rank", rank).where(F.col("rank") <= EXAMPLES).groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("examples"))
    return counts.join(some, "rule").select(F.lit(severity).alias("severity"), F.lit(file).alias("file"), "rule", "n", "examples")


def outside_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records with matches that aren't among their candidates: a warning."""
    pairs = lambda rows: rows.select("source1_entity_id", F.explode("ids").alias("id")).distinct()
    bad = pairs(matching).join(pairs(candidates), ["source1_entity_id", "id"], "left_anti")
    return _issues(bad.select(F.lit("match outside candidates").alias("rule"), F.col("source1_entity_id").alias("id")).distinct(), "warning", "matching")


def statistics(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"))


def validate(spark: SparkSession, matching: str, required: DataFrame, candidates: str | None = None, valid: DataFrame | None = None) -> DataFrame:
    """All issues of the files; a file without errors has none of severity ``error``."""
    found, parsed = [], {}
    for name, path, expected in (("matching", matching, MATCHING), ("candidates", candidates, CANDIDATES)):
        if path is None:
            continue
        header, lines = read_lines(spark, path)
        if wrong := header_issue(header, expected):
            found.append(spark.createDataFrame([("error", name, wrong, 1, header or "")], ISSUES))
            continue
        rows, malformed = parse(lines)
        parsed[name] = rows
        found.append(list_issues(rows, required, valid, malformed, name))
    if len(parsed) == 2:
        found.append(outside_candidates(parsed["matching"], parsed["candidates"]))
    return reduce(DataFrame.union, found)


def main(args: list[str] | None = None) -> int:
    """Print all issues of one file or two; 1 if one is an error, else 0."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("matching")
    parser.add_argument("--candidates")
    parser.add_argument("--source1", required=True, help="the records that need a row each")
    parser.add_argument("--known", nargs="*", default=[], help="sources whose ids may be named; without any, ids aren't looked up")
    a = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    ids = lambda path: read_tsv(spark, path, columns=["entity_id"]).select(F.col("entity_id").alias("id"))
    valid = reduce(DataFrame.union, map(ids, a.known)) if a.known else None
    issues = validate(spark, a.matching, ids(a.source1), a.candidates, valid)
    rows = issues.orderBy("severity", "file", "rule").collect()  # one for each rule and file
    for r in rows:
        print(f"{r.severity}: {r.file}: {r.rule} ({r.n}): {r.examples}")
    bad = any(r.severity == "error" for r in rows)
    print("failed" if bad else "passed")
    return int(bad)


if __name__ == "__main__":
    sys.exit(main())
