"""Line dedup against a plain version; the DuckDB statement on real pages; edges."""

from collections import Counter, defaultdict

import duckdb
import pytest

from starloom.llm import linededup as D

SF = "/root/testdata/sf0.01"


def plain(rows, ratio, least):
    lines, pages = defaultdict(Counter), Counter()
    for _, host, text in rows:
        pages[host] += 1
        lines[host].update({x.strip(" ") for x in (text or "").split("\n")} - {""})
    out = []
    for key, host, text in rows:
        bad = {x for x, n in lines[host].items() if n >= least and n > ratio * pages[host]}
        kept = None if text is None else [x for x in text.split("\n") if x.strip(" ") == "" or x.strip(" ") not in bad]
        if text is None:
            out.append((key, host, None, 0))
        else:
            out.append((key, host, "\n".join(kept), len(text.split("\n")) - len(kept)))
    return out


def test_against_plain_version(spark):
    rows = [(i, "h" if i % 3 else None, f"menu \n\nbody {i}\n  menu\nrare {i % 40}") for i in range(60)]
    rows += [(100 + i, "g", "only once here" if i else "menu") for i in range(8)]
    rows += [(200, "h", None), (201, "h", ""), (None, "h", "menu\nx"), (5, "h", "menu\nother"), (5, "h", "menu\nother")]
    df = spark.createDataFrame(rows, "page_id long, host string, text string")
    got = [tuple(r) for r in D.drop_boilerplate(df, "page_id", "host", "text", 0.3, 5).collect()]
    assert Counter(got) == Counter(plain(rows, 0.3, 5))
    assert sum(r[3] for r in got) > 0


def test_query_matches_sql(spark):
    got = D.op2_line_dedup(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    cur = con.execute(D.SQL)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(cur.fetchall())


def test_edges(spark):
    df = spark.createDataFrame([], "page_id long, host string, text string")
    assert D.drop_boilerplate(df, "page_id", "host", "text").count() == 0
    with pytest.raises(ValueError, match="exists"):
        D.drop_boilerplate(df.withColumnRenamed("page_id", "n_dropped"), "n_dropped", "host", "text")


def test_stage_keeps_every_document(spark):
    docs = spark.createDataFrame(
        [(i, f"head\ntext {i}", "en", "s", 11) for i in range(10)], "doc_id long, text string, lang string, source string, n_chars long"
    )
    got = D.stage_line_dedup(spark, docs, SF)
    assert got.columns == docs.columns and got.count() == 10
    assert {(r["text"], r["n_chars"]) for r in got.collect()} == {(f"text {i}", 6) for i in range(10)}


def test_stage_cuts_repeated_lines_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    given = docs.collect()
    texts, lines = defaultdict(set), defaultdict(set)
    split = lambda t: {x.strip(" ") for x in (t or "").split("\n")} - {""}
    for r in given:
        texts[r["source"]].add(r["text"])
        for x in split(r["text"]):
            lines[r["source"], x].add(r["text"])
    bad = {k for k, t in lines.items() if len(t) >= D.DOC_MIN and len(t) > D.DOC_RATIO * len(texts[k[0]])}
    out = {r["doc_id"]: r["text"] for r in D.stage_line_dedup(spark, docs, SF).collect()}
    assert len(out) == len(given)
    cut = 0
    for r in given:
        kept = [x for x in (r["text"] or "").split("\n") if x.strip(" ") == "" or (r["source"], x.strip(" ")) not in bad]
        assert out[r["doc_id"]] == (None if r["text"] is None else "\n".join(kept))
        cut += len((r["text"] or "").split("\n")) - len(kept)
    # the leading line of 997 texts is gone, lines of one text all stay
    assert cut > 6000 and not any("The and attion to thanedble the, anea. Eriner thanea." in split(t) for t in out.values())


def test_stage_counts_copies_once(spark):
    # a line of one text, however often copied, is none of the source's frame
    rows = [(i, "own line\nbody", "en", "s", 13) for i in range(8)]
    rows += [(10 + i, f"shared\nbody {i}", "en", "s", 13) for i in range(3)] + [(20 + i, f"pair\nother {i}", "en", "s", 12) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in D.stage_line_dedup(spark, docs, SF).collect()}
    assert {got[i] for i in range(8)} == {"own line\nbody"}
    assert {got[10 + i] for i in range(3)} == {f"body {i}" for i in range(3)}
    assert {got[20 + i] for i in range(2)} == {f"pair\nother {i}" for i in range(2)}
