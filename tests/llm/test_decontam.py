import hashlib
import random
import re

from loomgraph.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        ws = words(text)
        hit, found = set(), set()
        for item, t in items:
            iw = words(t)
            n = min(window, len(iw))
            for i in range(len(iw) - n + 1 if n else 0):
                for j in range(len(ws) - n + 1):
                    if ws[j : j + n] == iw[i : i + n]:
                        hit |= set(range(j, j + n))
                        found.add(str(item))
        out.append((doc, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def made(seed, n_docs=60, n_items=12):
    rng = random.Random(seed)
    vocabulary = ["A", "b", "c'", "é", "ÉA", "x1", " q", "d"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randint(0, 14))) for k in range(n_items)] + [(99, None), (3, text(9))]
    docs = [(k, text(rng.randint(0, 60))) for k in range(n_docs)]
    docs += [(200 + k, f"{text(5)} {t} {text(5)}") for k, (_, t) in enumerate(items) if t]
    return docs + [(500, None), (501, ""), (501, ""), (None, items[0][1])], items


def test_against_brute_force(spark):
    for seed in range(3):
        docs, items = made(seed)
        d = spark.createDataFrame([(*r, "n") for r in docs], "doc_id bigint, text string, n_hit string")
        b = spark.createDataFrame(items, "item_id bigint, text string")
        got = decontam.contamination_report(d, b, 4)
        want = brute(docs, items, 4)
        assert sorted(map(tuple, got.collect()), key=str) == want
        # The way for benchmarks beyond one block.
        blocks = decontam.contaminated(d, b, 4, block_bytes=40).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in blocks if r.doc_id is not None) == sorted(w[:4] for w in want if w[0] is not None)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontam.contamination_report(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert decontam.contamination_report(docs, items.limit(0)).first().contaminated is False


def test_very_common_passage(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j " * 20_000)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id bigint, text string")
    assert decontam.contamination_report(docs, items).first().n_hit == 200_000


def test_items_without_an_id_equal_the_sql(spark):
    import duckdb

    from loomgraph.llm import queries

    one, two = (" ".join(f"{x}{k}" for k in range(14)) for x in "ab")
    docs = [(1, f"x {one} y"), (2, f"{one} and {two}"), (3, "clean words only"), (4, f"{two} z"), (None, one)]
    items = [(None, one), (None, "short item"), ("i1", two), ("i2", None), (None, None), (None, one)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id varchar, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id string, text string")
    df = decontam.contamination_report(*frames, queries.WINDOW)
    want = con.execute(f"select {', '.join(df.columns)} from ({queries.ORACLE_SQL['op9_decontam']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert sum(r[2] > 0 for r in want) == 4
    small = decontam.contaminated(*frames, queries.WINDOW, block_bytes=20)
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in small.collect()} == {(r.doc_id, r.n_hit, tuple(r["items"])) for r in decontam.contaminated(*frames, queries.WINDOW).collect()}


def test_clean_rows_keep_all_columns(spark):
    """Columns named like the operator's own stay; several blocks drop what one drops."""
    docs, items = made(7)
    d = spark.createDataFrame([(*r, "n", 5, None) for r in docs], "doc_id bigint, text string, n_hit string, _hit1 int, items string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    clean = {w[0] for w in brute(docs, items, 4) if not w[-1]}
    for limit in (1 << 20, 40):
        got = decontam.drop_contaminated(d, b, 4, block_bytes=limit)
        assert got.columns == d.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(*r, "n", 5, None) for r in docs if r[0] in clean], key=str)
