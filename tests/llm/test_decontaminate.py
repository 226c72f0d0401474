import hashlib
import random
import re

from pyspark.sql import functions as F

from playmart.llm import decontaminate as D, queries
from playmart.session import scratch_path
from tests.conftest import tuples
from tests.llm.conftest import AWKWARD

ITEMS = "item_id bigint, text string"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(str(item))
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for win, owners in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def corpus(rng):
    vocabulary = ["the", "of", "É", "é", "a1", "日本"] + [f"w{k}" for k in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([3, 9, 10, 11, 25]))) for k in range(12)]
    items += [(12, ""), (13, None), (14, "  ,. "), (3, text(15)), (15, "the the the the"),
              (16, "w1"), (17, "Word Word word")]
    rows = list(AWKWARD)
    for k in range(60):
        body = text(rng.randrange(30))
        if k % 2:
            body += ". " + (rng.choice(items)[1] or "").upper().replace(" ", ",\n") + " " + text(4)
        rows.append((1000 + k, body))
    rows += [(2000, (items[0][1] + " ") * 30), (2001, "the " * 50), (2001, "the " * 50)]
    return rows, items


def test_query_equals_brute_force(spark, docs, tmp_path):
    rows, items = corpus(random.Random(11))
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuples(queries.op2_decontaminate(spark, str(tmp_path))), key=str)
    assert got == sorted(brute(rows, items), key=str)


def test_clean_keeps_rows_without_a_window(spark, docs):
    rows, items = corpus(random.Random(12))
    df = docs(rows).withColumnRenamed("lang", "hash").withColumnRenamed("source", "wid")
    kept = D.clean(df, spark.createDataFrame(items, ITEMS))
    hit = [b[-1] for b in brute(rows, items)]
    assert kept.columns == df.columns
    assert sorted(tuples(kept, "doc_id", "text"), key=str) == sorted(
        (r for r, h in zip(rows, hit) if not h), key=str)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "plain words")], ITEMS)
    assert D.clean(docs(AWKWARD), none).count() == len(AWKWARD)
    assert D.contamination(docs([]), some).count() == 0
    assert D.contamination(docs(AWKWARD), some).where("contaminated").count() == 2


def test_proximity_in_any_order(spark, docs):
    rows = [(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha x x x x x beta gamma"),
            (4, "alpha beta"), (5, None)]
    df = docs(rows)
    listed = spark.createDataFrame([(0, ["alpha", "beta", "gamma"]), (1, ["beta"]),
                                    (2, ["alpha", "alpha", "nowhere"])], "wid bigint, phrase array<string>")
    terms = D.test_terms(listed)
    index = D.write_index(df, terms, scratch_path(spark, "near"))

    def places(wid, within):
        found = D.proximity_matches(index, listed, terms, within).where(F.col("wid") == wid)
        return sorted({r.doc for r in found.select("doc").collect()})
    # gamma is the rarest and the anchor
    assert places(0, 2) == [2]
    assert places(0, 4) == [1, 2] and places(0, 7) == [1, 2, 3]
    assert places(1, 2) == [1, 2, 3, 4] and places(2, 9) == []
    exact = D.phrase_matches(index, listed, terms).where("wid = 0")
    assert exact.count() == 0
