import random
import re
from collections import defaultdict

import xxhash

from playmart.llm import queries, simhash as S
from playmart.llm.components import components
from tests.conftest import tuples
from tests.llm.conftest import AWKWARD


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(7)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 700)]
    pairs += [(901, 902), (902, 903), (903, 901), (7, 7)]
    pairs += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    rng.shuffle(pairs)
    edges = spark.createDataFrame([p if rng.random() < 0.5 else p[::-1] for p in pairs],
                                  "a bigint, b bigint")
    got = dict(tuples(components(edges), "bits", "root"))
    proper = [p for p in pairs if p[0] != p[1]]
    want = roots({n for p in proper for n in p}, proper)
    assert got == want
    assert components(edges.limit(0)).count() == 0


def test_links_equal_all_pairs_where_values_are_crowded(spark):
    """Clusters that share halves with many others, beside random prints."""
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for _ in range(4):
        centre = rng.getrandbits(64)
        prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
        half = rng.getrandbits(32) << 32  # one upper half with many lower halves
        prints |= {half | rng.getrandbits(32) for _ in range(30)}
        prints |= {half ^ (1 << 40) | rng.getrandbits(8) for _ in range(30)}
    prints = sorted(prints)
    for most in (1, 2):
        pairs = [(a, b) for i, a in enumerate(prints) for b in prints[:i]
                 if (a ^ b).bit_count() <= most]
        df = spark.createDataFrame([(S.signed(p),) for p in prints], "bits bigint")
        found = [(a % (1 << 64), b % (1 << 64)) for a, b in tuples(S.links(df, most), "a", "b")]
        assert all((a ^ b).bit_count() <= most for a, b in found)
        assert roots(prints, found) == roots(prints, pairs)


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_hash_is_the_one_of_the_engine(spark):
    df = spark.sql("SELECT xxhash64('É a b') AS h")
    assert df.first()[0] % (1 << 64) == int(S.shingle_hashes("É A\tb", 3)[0])


def test_query_on_awkward_rows(spark, docs, tmp_path):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(400)]
    rows = list(AWKWARD) + [(50 + k, " ".join(base[:300] + [f"q{k % 3}"])) for k in range(12)]
    rows += [(100 + k, " ".join(rng.sample(base, 40))) for k in range(30)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op6_simhash(spark, str(tmp_path)).collect()
    prints = {t: brute_print(t) for _, t in rows}
    distinct = sorted(set(prints.values()))
    root = roots(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[:i]
                            if (a ^ b).bit_count() <= 2])
    least = defaultdict(list)
    for i, t in rows:
        least[root[prints[t]]].append(i)
    want = [(i, f"{prints[t]:016x}", min((x for x in least[root[prints[t]]] if x is not None),
                                         default=None)) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert S.near_duplicates(docs([])).count() == 0


def edited(words, rng, share):
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in words)


def test_near_copies_leave_one_row(spark, docs):
    rng = random.Random(10)
    rows, expected = [], set()
    for g in range(25):
        words = [f"g{g}w{k}" for k in range(300)]
        rows += [(100 * g + 90 - k, edited(words, rng, 0.006 if k else 0)) for k in range(6)]
        rows += [(100 * g + 5, " ".join(words))] * 2  # the smallest id, and repeated
        expected.add(100 * g + 5)
    clean = [(5000 + k, " ".join(f"c{k}w{j}" if j % 2 else f"common{j}" for j in range(120)))
             for k in range(60)]
    kept = S.keep_one(docs(rows + clean))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected | {i for i, _ in clean})
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_keep_one_on_awkward_rows(spark, docs):
    kept = sorted(tuples(S.keep_one(docs(AWKWARD)), "doc_id", "text"), key=str)
    # null, empty and blank texts are alike: no words; the smallest id of theirs stays
    assert len(kept) == len({t for _, t in AWKWARD if t and t.strip()}) + 1
    assert kept.count((1, "plain words in a row")) == 1
    assert [t for i, t in kept if i == 2] == [None]
    assert S.keep_one(docs([])).count() == 0


def jaccard_groups(rows, words=5, similarity=0.8):
    """What stays by brute force over all pairs of texts."""
    sets = {i: set(S.shingle_hashes(t, words).tolist()) for i, t in rows}
    ids = sorted(sets)
    holders = defaultdict(list)
    for i in ids:
        for h in sets[i]:
            holders[h].append(i)
    pairs = []
    for i in ids:
        n = defaultdict(int)
        for h in sets[i]:
            for j in holders[h]:
                if j < i:
                    n[j] += 1
        pairs += [(j, i) for j, k in n.items() if k >= similarity * (len(sets[i]) + len(sets[j]) - k)]
    return set(roots(ids, pairs).values())


def test_pairs_among_many_texts_of_one_template(spark, docs):
    """Thousands of texts share most of their words; each has one true near copy or none."""
    rng = random.Random(20)
    template, rows = [f"t{k}" for k in range(105)], []
    for k in range(1500):
        own = [f"o{k}w{j}" for j in range(45)]
        rows.append((2 * k, " ".join(template + own)))
        if k % 3 == 0:
            at = rng.randrange(45)
            rows.append((2 * k + 1, " ".join(template + own[:at] + ["new"] + own[at:])))
    rows = rng.sample(rows, len(rows))
    kept = {r.doc_id for r in S.keep_one(docs(rows)).collect()}
    assert kept == {2 * k for k in range(1500)}


def test_crowds_of_near_copies_equal_brute_force(spark, docs):
    """Groups about the border: heavy templates, chains, loose crowds and texts made of hot lines."""
    rng = random.Random(21)
    rows = []
    for share in (60, 85, 90, 95):
        base = [f"s{share}t{k}" for k in range(share)]
        rows += [" ".join(base + [f"s{share}o{k}w{j}" for j in range(100 - share)]) for k in range(40)]
    base = [f"c{k}" for k in range(200)]
    rows += [edited(base, rng, share) for share in (0.01, 0.02, 0.03, 0.05) for _ in range(40)]
    rows += [" ".join(base[k:k + 120]) for k in range(0, 80, 3)]  # a chain of shifted texts
    lines = [" ".join(f"l{n}w{j}" for j in range(14)) for n in range(14)]
    rows += [" ".join(rng.sample(lines, 11)) for _ in range(80)]
    rows = list(enumerate(dict.fromkeys(rows)))
    assert {r.doc_id for r in S.keep_one(docs(rows)).collect()} == jaccard_groups(rows)


def test_pairs_are_found_whatever_the_number_of_texts(spark, docs):
    """Copies at Jaccard 0.8 to 0.9 by a replaced block, an appended one or scattered words, among
    so many short texts that chance meetings count."""
    rng = random.Random(22)
    rows, kept = [(1_000_000 + k, f"short {k} text of {k % 7} words {k}") for k in range(17_000)], set()
    kept |= {i for i, _ in rows}
    for g in range(120):
        words = [f"g{g}w{k}" for k in range(300)]
        block = [f"g{g}n{k}" for k in range(60)]
        copy = [words[:100] + block[:28] + words[128:], words + block, words + block[:30],
                [f"x{g}{w}" if k % 50 == 7 else w for k, w in enumerate(words)]][g % 4]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
        kept.add(2 * g)
    assert {r.doc_id for r in S.keep_one(docs(rng.sample(rows, len(rows)))).collect()} == kept


def test_copies_with_a_repeated_line(spark, docs):
    rows = []
    for g in range(40):
        words, line = [f"g{g}w{k}" for k in range(300)], [f"g{g}l{k}" for k in range(12)]
        rows += [(2 * g, " ".join(words + line)), (2 * g + 1, " ".join(words + line * 10))]
    assert {r.doc_id for r in S.keep_one(docs(rows)).collect()} == {2 * g for g in range(40)}


def test_near_copies_go_through_the_signatures(spark, docs, monkeypatch):
    """Pairs whose fingerprints meet are joined by them; the exact check gets only the others."""
    rng = random.Random(23)
    rows = []
    for g in range(20):
        words = [f"g{g}w{k}" for k in range(1500)]
        rows += [(3 * g, " ".join(words)), (3 * g + 1, " ".join(words[:-1])),
                 (3 * g + 2, edited(words, rng, 0.01))]
    asked, check = [], S.verified

    def seen(pairs, *args):
        out = check(pairs, *args)
        asked.append(({tuple(r) for r in pairs.collect()}, {tuple(r) for r in out.collect()}))
        return out

    monkeypatch.setattr(S, "verified", seen)
    kept = {r.doc_id for r in S.keep_one(docs(rows)).collect()}
    assert kept == jaccard_groups(rows) == {3 * g for g in range(20)}
    (first, joined), *later = asked
    assert len(joined) >= 15 and joined <= first and later
    assert not any(joined & pairs for pairs, _ in later)


def test_edited_copies_of_one_text_are_not_paired_throughout(spark, docs, monkeypatch):
    """Copies below the similarity to each other, though not to their text: its place must not matter
    and the pairs that are compared follow the number of copies, not its square."""
    rng = random.Random(24)
    base, rows = [f"b{k}" for k in range(150)], []
    for k in range(400):
        words = list(base)
        for n, at in enumerate(rng.sample(range(5, 145, 7), 3) if k != 250 else []):
            words[at] = f"e{k}n{n}"
        rows.append((k, " ".join(words)))
    loose = [f"l{k}" for k in range(150)]  # and a group that no text is near to
    rows += [(1000 + k, " ".join(f"x{k}{w}" if n in at else w for n, w in enumerate(loose)))
             for k in range(60) for at in [rng.sample(range(5, 145, 7), 4)]]
    asked, check = [], S.verified

    def seen(pairs, *args):
        asked.append(pairs.count())
        return check(pairs, *args)

    monkeypatch.setattr(S, "verified", seen)
    kept = {r.doc_id for r in S.keep_one(docs(rng.sample(rows, len(rows)))).collect()}
    assert kept == jaccard_groups(rows) and kept & set(range(400)) == {0}
    assert sum(asked) < 12 * len(rows), asked


def test_a_crowd_of_pairs_is_dealt_out(spark):
    pairs = spark.range(1, 4 * S.PAIRS).selectExpr("0L AS a", "id AS b")
    sizes = spark.range(4 * S.PAIRS).selectExpr("id", "10 AS size")
    assert S.homes(pairs, sizes).select("home").distinct().count() >= 3
