import collections

from pyspark.sql import functions as F

from tablecraft.llm import linededup
from tablecraft.llm.queries import QUERIES


def brute_force(rows, ratio, min_pages):
    pages = collections.defaultdict(set)
    for host, text in rows:
        if text is not None:
            pages[host].add(text)
    drop = collections.defaultdict(set)
    for host, texts in pages.items():
        seen = collections.Counter(x for t in texts for x in {line.strip(" ") for line in t.split("\n")} if x)
        drop[host] = {x for x, n in seen.items() if n >= min_pages and n / len(texts) >= ratio}
    out = []
    for host, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(" ") not in drop[host]]
        out.append((host, text, None if text is None else "\n".join(kept), len(lines) - len(kept)))
    return out


def check(df, ratio, min_pages):
    rows = [tuple(r) for r in df.select("source", "text").collect()]
    out = linededup.drop_boilerplate(df.withColumn("before", F.col("text")), "source", "text", ratio, min_pages, "dropped")
    got = [(r.source, r.before, r.text, r.dropped) for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute_force(rows, ratio, min_pages), key=str)
    assert set(df.columns) <= set(out.columns)


def test_hosts_have_their_own_boilerplate(spark):
    rows = []
    for i in range(60):
        host = ["big", "big", "small", None][i % 4]
        lines = [f"body {i}", "", f" menu of {host} ", "footer" if i % 3 else "other footer", f"body {i}"]
        rows.append((i, host, "\n".join(lines), 1, 1))
    rows += [(100 + i, "big", rows[0][2], 1, 1) for i in range(50)]  # copies do not count
    rows += [(200, "big", None, 1, 1), (201, None, "", 1, 1), (202, "one page", "menu of big\nfooter", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string, _host int, _lines int")
    check(df, 0.5, 3)
    check(df, 0.02, 5)


def test_odd_documents(odd_documents):
    check(odd_documents, 0.05, 2)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id int, source string, text string")
    assert linededup.drop_boilerplate(df, "source").collect() == []


def test_query(spark, sf):
    out = QUERIES["op9_line_dedup"](spark, sf)
    assert out.columns == ["doc_id", "n_dropped", "n_chars_kept", "kept_sha256"]
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
