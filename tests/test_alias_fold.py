"""Aliases folded into a group's first row against a plain loop: nulls, blanks, cases, ties of place, a group with most of the rows."""
from pyspark.sql import functions as F

from cairn.operators import curation


def plain(rows):
    """rows (k, size, id, name, aliases), a group's in order of falling size and id."""
    out, seen = {}, {}
    for k, _, _, name, aliases in sorted(rows, key=lambda r: (-r[1], r[2])):
        first = k not in out
        if first:
            out[k], seen[k] = (name, []), {name.lower()} if name is not None else set()
        for x in [*([] if first else [name]), *(aliases or [])]:
            if x is not None and x.strip(" ") and x.lower() not in seen[k]:
                seen[k].add(x.lower())
                out[k][1].append(x)
    return out


def folded(spark, rows):
    df = spark.createDataFrame(rows, "k string, size int, id long, name string, more array<string>").repartition(5)
    out = curation.folded_aliases(df, ["k"], "name", "more", [F.desc("size"), F.col("id")])
    assert out.columns == ["k", "name", "aliases"]
    return {r.k: (r["name"], r["aliases"]) for r in out.collect()}


def test_nulls_blanks_and_cases(spark):
    rows = [
        ("a", 3, 1, None, ["X", None, " "]), ("a", 2, 2, "x", ["Y", "y", "Z"]), ("a", 1, 3, "Name", None),  # a survivor without a name keeps the others'
        ("b", 1, 1, " ", ["B", "b"]), ("b", 1, 2, "C", []), (None, 5, 1, "N", ["n", "M", "m "]), (None, 5, 2, "O", ["M"]), ("c", 1, 1, "only", None),
    ]
    assert folded(spark, rows) == plain(rows)
    assert folded(spark, []) == {}


def test_a_group_with_most_of_the_rows(spark):
    rows = [("hot" if i % 50 else f"k{i % 7}", i * 7_919 % 101, i, f"Name{i * i % 37}", [f"NAME{i % 41}", f"alias{i % 29}"]) for i in range(30_000)]
    assert folded(spark, rows) == plain(rows)
