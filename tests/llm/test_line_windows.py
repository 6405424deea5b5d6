import pytest

from airshed.llm import line_windows as lw

from .conftest import ODD


def brute(rows, width=3):
    """Rows in order of key (null last); occurrences in rows of one key are not later than each other,
    but a repeat inside a text is."""
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        k, t = rows[i]
        if t is None:
            out.append((k, None, 0))
            continue
        lines, gone, seen = t.split("\n"), set(), set()
        for p in range(len(lines) - width + 1):
            w = tuple(lines[p:p + width])
            if w in seen or first.setdefault(w, k) != k:
                gone |= set(range(p, p + width))
            seen.add(w)
        out.append((k, "\n".join(x for p, x in enumerate(lines) if p not in gone), len(gone)))
    return sorted(out, key=str)


CASES = [(10, "a\nb\nc\nd"), (11, "x\na\nb\nc\ny"), (12, "a\nb\nc"), (13, "b\nc\nd\ne"), (14, "q\nq\nq\nq\nq"), (15, "a\nb"), (16, "\n\n\n\n"),
         (12, "a\nb\nc"), (12, "other\na\nb\nc"), (None, "a\nb\nc\nz")]


@pytest.mark.parametrize("rows", [ODD, CASES, ODD + CASES, [(None, "n\nn\nm"), (None, "n\nn\nm")]])
def test_against_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, k string, pos int")
    got = lw.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "k", "pos", "lines_removed"]
    assert sorted([(r["doc_id"], r["text"], r["lines_removed"]) for r in got.collect()], key=str) == brute(rows)


def test_empty_table_and_taken_name(spark, empty):
    from pyspark.sql import functions as F
    assert lw.dedup_lines(empty).count() == 0
    with pytest.raises(ValueError):
        lw.dedup_lines(empty.withColumn("LINES_REMOVED", F.lit(1)))
