"""Every operator against SQL, brute force, a round trip or held-out labels, and on odd rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.oracle import duck, spark_rows
from tidemark.llm import decontaminate, host_rules, kernel, language_id, license_scan, line_dedup, near_dedup, packing, quality, queries, substring_dedup, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, host string, kept string, score string, sig string, n_lines string, __x int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def words(seed, n):
    r = random.Random(seed)
    return [r.choice(WORDS) + str(r.randrange(400)) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, len(t) if t is not None else None, 7, "h", "k", "s", "g", "l", 1) for i, t, g, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, clashing names."""
    base = " ".join(words(1, 120))
    long = "\n".join(" ".join(words(1000 + s, 60)) for s in range(900))
    rows = [(1, base, "en", "a"), (1, base, "en", "a"), (2, base, "en", "b"), (3, base + " tail", None, None), (4, None, "en", "a"), (5, "", "en", "a"), (6, " \n\t ", "en", "a"), (7, long, "fr", "a"), (None, base, "en", "a"), (None, None, None, None), (8, "Ünï çødé ☃ <|endoftext|>", "en", "b"), (9, long, "fr", "c"), (10, "one", "en", "c")]
    return table(spark, rows).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def by_id(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, data, name):
    assert spark_rows(queries.queries()[name](spark, data)) == duck(data, SQL[name])


def test_kernel_slices():
    texts = ["", "a b\n\nc", None, "é x ", "\n", "word"]
    b = next(kernel.blocks(pa.array(texts)))
    raw = b.data.tobytes()
    s, e, f = b.words()
    assert [raw[x:y].decode() for x, y in zip(s, e)] == ["a", "b", "c", "é", "x", "word"] and f.tolist() == [0, 0, 3, 3, 5, 5, 6]
    s, e, f = b.lines()
    assert [raw[x:y].decode() for x, y in zip(s, e)] == ["", "a b", "", "c", "", "é x ", "", "", "word"] and f.tolist() == [0, 1, 4, 5, 6, 8, 9]
    assert len(set(b.hashes(s, e).tolist())) == 5


def thue_morse(n, a, b):
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


def test_kernel_tells_thue_morse_strings_apart(spark):
    """Such strings agree under any polynomial modulo a power of two."""
    texts = [thue_morse(n, *ab) for n in (1024, 2048, 4096) for ab in ("ab", "ba", "xy", "yx")]
    b = next(kernel.blocks(pa.array(texts)))
    assert len(set(b.hashes(b.off[:-1], b.off[1:]).tolist())) == len(texts)
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    rows = [(i, f"{one}\nown {i}", "en", f"s{i}") for i in range(9)] + [(100 + i, f"{two}\nown {i}", "en", f"t{i}") for i in range(3)]
    assert line_dedup.remove_lines(table(spark, rows), min_sites=10).agg(F.sum("n_removed")).first()[0] == 0
    pair = [(1, " ".join([one] * 9), "en", "s"), (2, " ".join([two] * 9), "en", "s")]
    assert {r["component_id"] for r in near_dedup.near_duplicates(table(spark, pair), k=3, percent=85).collect()} == {1, 2}
    tok = packing.PieceTokenizer(packing.default_tokenizer())
    ids, first, _ = tok.encode(next(kernel.blocks(pa.array([one, two]))))
    assert [tok.own.decode(ids[x:y].tolist()) for x, y in zip(first[:-1], first[1:])] == [one, two]
    got = {x["doc_id"]: tuple(x)[1:] for x in substring_dedup.remove_repeats(table(spark, pair), with_text=False).collect()}
    assert got == brute_substrings(pair, 100)


def test_host_rules(odd, none, spark):
    got = by_id(host_rules.judge(odd))
    assert len(got[1]) == 2 and got[4][0]["n_words"] == 0 and got[4][0]["base_failed"] and len(got[None]) == 2
    assert got[7][0]["n_words"] == 54000
    assert host_rules.judge(none).count() == 0
    bad = table(spark, [(i, " ".join(words(i, 60)) if i % 10 == 0 else "x", "en", "bad") for i in range(400)] + [(1000 + i, " ".join(words(i, 60)), "en", "good") for i in range(400)])
    kept = {r["doc_id"] for r in host_rules.judge(bad).where("kept").collect()}
    assert kept == set(range(1000, 1400))


def test_host_verdicts_equal_sql(spark, tmp_path):
    """A table in which the verdict of a host, and not only a document's own rules, decides."""
    r = random.Random(31)
    rows = []
    for i in range(600):
        host = r.choice(["good.org", "bad.org", "mixed.org", f"one{i}.org", None])
        short = r.random() < {"good.org": 0.05, "bad.org": 0.85, "mixed.org": 0.5}.get(host, 0.3)
        rows.append((i, "few words" if short else " ".join(words(i, 60)), "en", host))
    docs = table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = spark_rows(queries.queries()["op10_host_rules"](spark, str(tmp_path)))
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    q = c.execute(host_rules.SQL)
    names = [x[0] for x in q.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert got == (sorted(names), sorted(tuple(str(row[i]) for i in order) for row in q.fetchall()))
    kept, base = names.index("kept"), names.index("base_failed")
    by_host = [row for row in c.execute(host_rules.SQL).fetchall() if not row[kept] and not row[base]]
    assert len(by_host) > 5


def test_url_filter(spark):
    p = spark.createDataFrame([(1, "http://A.Example.NET/en/x", 0), (2, "http://x.net", 0), (3, "http://x.net/", 0), (4, None, 0), (5, "ftp:/none", 0), (6, "http://casino.org/a", 0), (7, "http://mycasinos.org/", 0), (8, "http://o.org/cheap-poker?cheap", 0), (9, "http://o.org/cheap/cheap", 0), (10, "http://notexample.com/de/", 0), (10, "http://w.Example.com/de/?x", 0)], "page_id long, url string, host int")
    got = {(r["page_id"], r["host"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(p).collect()}
    assert got == {(1, "a.example.net", "example.net/en/", "allow"), (2, "x.net", None, "allow"), (3, "x.net", "net/", "block"), (4, "", None, "allow"), (5, "", None, "allow"), (6, "casino.org", None, "block"), (7, "mycasinos.org", None, "allow"), (8, "o.org", None, "block"), (9, "o.org", None, "allow"), (10, "notexample.com", None, "allow"), (10, "w.example.com", "example.com/de/", "block")}
    assert url_filter.judge_urls(p.where("false")).count() == 0
    ties = (("b.org", "/x", "allow"), ("org", "/x.b", "block"), ("b.org", "/y", "block"), ("b.org", "/y", "allow"))
    p = spark.createDataFrame([(1, "http://a.b.org/x.b"), (2, "http://b.org/yy?" + "q" * 500000), (3, "http://c.net/" + "a/" * 200000 + "porn/"), (4, "http://c.net/sexy-sexy"), (5, "http://c.net/sexy/poker")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(p, rules=ties).collect()}
    assert got == {1: ("b.org/x", "allow"), 2: ("b.org/y", "block"), 3: (None, "block"), 4: (None, "allow"), 5: (None, "block")}
    assert {r["verdict"] for r in url_filter.judge_urls(p, vocabulary={}, rules=()).collect()} == {"allow"}


def brute_near(rows, k, percent):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = [x for x in w.replace("\t", " ").replace("\n", " ").split(" ") if x]
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    low = {}
    for i, r in enumerate(rows):
        low[top(i)] = min(low.get(top(i), r[0]), r[0])
    return {r[0]: (len(sets[i]), low[top(i)]) for i, r in enumerate(rows)}


def test_near_duplicates_equal_all_pairs(spark):
    r = random.Random(5)
    rows = []
    for g in range(25):
        w = words(g, r.choice([3, 9, 60, 150]))
        for _ in range(r.choice([1, 2, 9])):
            v = [("new%d" % r.randrange(10**6) if r.random() < 0.012 else x) for x in w]
            rows.append((len(rows) + 1, " ".join(v), "en", "s"))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(table(spark, rows), k=3, percent=85).collect()}
    assert got == brute_near(rows, 3, 85)


def test_near_duplicates_dense_region(spark, monkeypatch):
    """Regions above the limit go deeper and are dealt into blocks; nothing is lost by that."""
    monkeypatch.setattr(near_dedup, "REGION", 8)
    w = words(3, 300)
    rows = [(i, " ".join(w[:i % 60] + [f"e{i}"] + w[i % 60 :]), "en", "s") for i in range(1, 61)]
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(table(spark, rows), k=3, percent=85).collect()}
    assert got == brute_near(rows, 3, 85)


def star(seed, n, length=240, swaps=6):
    """A base and variants that are near to it but not to each other."""
    r = random.Random(seed)
    base = words(seed, length)
    rows = [(1, " ".join(base), "en", "s")]
    for i in range(2, n + 1):
        v = list(base)
        for at in r.sample(range(length), swaps):
            v[at] = f"own{i}x{at}"
        rows.append((i, " ".join(v), "en", "s"))
    return rows


@pytest.mark.parametrize("last", [False, True])
def test_near_duplicates_star_in_large_regions(spark, monkeypatch, last):
    """Variants that only their base links fall apart at depth; regions above the limit are searched whole."""
    monkeypatch.setattr(near_dedup, "REGION", 8)
    rows = star(11, 120) + [(1000 + i, t, g, s) for i, t, g, s in star(12, 40)]
    if last:
        rows = [(5000 - i, t, g, s) for i, t, g, s in rows]
    want = brute_near(rows, 3, 85)
    assert len({c for _, c in want.values()}) == 2
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(table(spark, rows), k=3, percent=85).collect()}
    assert got == want


def test_near_duplicates_star_in_blocks(spark, monkeypatch):
    """A group that no depth divides is dealt into blocks; members that only their base links stay linked."""
    monkeypatch.setattr(near_dedup, "REGION", 8)
    monkeypatch.setattr(near_dedup, "DEPTHS", (4,))
    rows = [(500 - i, t, g, s) for i, t, g, s in star(13, 150)]
    want = brute_near(rows, 3, 85)
    assert len({c for _, c in want.values()}) == 1
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(table(spark, rows), k=3, percent=85).collect()}
    assert got == want


def test_near_duplicates_meet_every_candidate_once(spark, monkeypatch):
    """Every pair that shares a tree's first coordinates is met in one tree, whatever the sizes of its regions."""
    monkeypatch.setattr(near_dedup, "REGION", 8)
    r = np.random.default_rng(3)
    sig = np.repeat(r.integers(0, 256, (4, near_dedup.PERMS)), [90, 20, 6, 1], axis=0).astype(np.uint8)
    other = r.random(sig.shape) < r.choice([0.02, 0.1, 0.2], (len(sig), 1))
    sig[other] = r.integers(0, 256, int(other.sum()))
    nodes = spark.createDataFrame([(i, 100, s.tobytes()) for i, s in enumerate(sig)], "rep long, n long, sig binary").cache()
    full = near_dedup._regions(nodes).join(nodes, "rep").withColumn("component", F.when(F.col("rep") % 3 == 0, -1).otherwise(F.col("rep"))).withColumn("side", F.lit(0))
    fields = list(near_dedup._OPEN) + ["sig"]
    rows = full.where("level = 0").select(fields).union(near_dedup._dealt(full.where("level = -1").drop("side")).select(fields)).toPandas()
    got = collections.Counter()
    for _, g in rows.groupby("region"):
        g = {c: g[c].to_numpy() for c in fields[:-1]} | {"sig": np.stack([np.frombuffer(s, np.uint8) for s in g["sig"]])}
        for x, y, _ in near_dedup._near(g, 85, 92):
            got.update(tuple(sorted(p)) for p in zip(g["rep"][x].tolist(), g["rep"][y].tolist()))
    same = sig[:, None, :] == sig[None, :, :]
    meet = np.any([same[:, :, 4 * t : 4 * t + 4].all(2) for t in range(near_dedup.TREES)], axis=0) & (same.sum(2) >= 92)
    want = {(i, j) for i, j in np.argwhere(meet).tolist() if i < j and not i % 3 == j % 3 == 0}
    assert len(want) > 1000 and got == dict.fromkeys(want, 1)


def test_near_duplicates_heavy_sets(spark, monkeypatch):
    """Regions whose sets are too large to be held at once are dealt into blocks; nothing is lost by that."""
    monkeypatch.setattr(near_dedup, "WEIGHT", 900)
    rows = star(17, 40) + [(1000 + i, t, g, s) for i, t, g, s in star(18, 12)]
    want = brute_near(rows, 3, 85)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(table(spark, rows), k=3, percent=85).collect()}
    assert got == want and len({c for _, c in want.values()}) == 2


def test_near_duplicates_planted_in_a_dense_region(spark):
    """Members of a dense region that are alike by chance, with pairs just above the threshold, at the real limit."""
    r = random.Random(21)
    base = words(21, 400)

    def variant(of, swaps, tag):
        v = list(of)
        for at in r.sample(range(len(v)), swaps):
            v[at] = f"{tag}x{at}"
        return v

    rows, planted = [], {}
    for i in range(1, 1501):
        rows.append((i, variant(base, 17, f"o{i}")))
    for i in range(1, 1501, 8):
        copy = variant(rows[i - 1][1], 9, f"c{i}")
        rows.append((10000 + i, copy))
        planted[10000 + i] = i
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(table(spark, [(i, " ".join(w), "en", "s") for i, w in rows]), k=1, percent=85).collect()}
    sets = {i: set(w) for i, w in rows}
    links = [(a, b) for a, b in planted.items() if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert len(links) > 150 and all(got[a] == got[b] for a, b in links)


def test_near_duplicates_odd(odd, none):
    got = by_id(near_dedup.near_duplicates(odd))
    assert {r["component_id"] for i in (1, 2, 3) for r in got[i]} == {1} and [r["kept"] for r in got[2]] == [False]
    assert got[9][0]["component_id"] == 7 and got[4][0]["component_id"] == 4 and got[4][0]["n_shingles"] == 0 and got[5][0]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in got[None]) and got[10][0]["n_shingles"] == 1
    kept = near_dedup.keep_one(odd)
    both = table(odd.sparkSession, [(1, "a b c d e f", "en", "s"), (2, "a b c d e f", "en", "s"), (2, "one of its own", "en", "s")])
    assert sorted((r[0], r[1]) for r in near_dedup.keep_one(both).collect()) == [(1, "a b c d e f"), (2, "one of its own")]
    assert kept.columns == odd.columns and sorted(str(r[0]) for r in kept.collect()) == sorted(map(str, [1, 1, 4, 5, 6, 7, None, None, 8, 10]))
    assert near_dedup.near_duplicates(none).count() == 0


def brute_substrings(rows, length):
    seen, out = {}, {}
    for i, t, *_ in sorted(rows):
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                cover[p] += 1
                cover[p + length] -= 1
            seen.setdefault(b[p : p + length], i)
        gone = np.cumsum(cover[:-1]) > 0
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]).sum()), hashlib.sha256(left).hexdigest())
    return out


def test_substrings_equal_brute_force(spark):
    r = random.Random(9)
    shared = [" ".join(words(100 + s, 40)) for s in range(4)]
    rows = []
    for i in range(1, 60):
        parts = [" ".join(words(i * 7 + k, r.randrange(30))) for k in range(4)]
        parts.insert(r.randrange(4), r.choice(shared)[r.randrange(30) :])
        if i % 9 == 0:
            parts.append("ab" * r.randrange(20, 200) + "é" * 70)
        if i % 10 == 0:
            parts = [rows[-1][1]]
        rows.append((i, " ".join(parts), "en", "s"))
    got = {x["doc_id"]: tuple(x)[1:] for x in substring_dedup.remove_repeats(table(spark, rows), with_text=False).collect()}
    assert got == brute_substrings(rows, 100)


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_substrings_of_hot_triggers(spark, most):
    """One passage in every text: its edges' triggers have a phrase a text, which go by strings beyond ``most``."""
    r = random.Random(4)
    common = " ".join(words(77, 30))
    rows = []
    for i in range(1, 41):
        near = common if i % 5 else common[:90] + f"{i}" + common[90:]
        rows.append((i * 3, " ".join(words(i, r.randrange(25))) + (" " if i % 2 else "") + near[: r.randrange(120, 200)] + " ".join(words(-i, 5)) + common[30:160], "en", "s"))
    got = {x["doc_id"]: tuple(x)[1:] for x in substring_dedup.remove_repeats(table(spark, rows).repartition(5), with_text=False, most_phrases=most).collect()}
    assert got == brute_substrings(rows, 100)


def test_dictionary_decides_in_byte_order():
    """Every start of random phrases of few letters, zero bytes among them, against all pairs."""
    r = np.random.default_rng(1)
    length, reach = 12, 7
    for _ in range(30):
        m = int(r.integers(2, 40))
        trigger = bytes([9, 9])
        group, ids, tag, start = r.integers(0, 3, m), r.integers(0, 6, m), np.zeros(m, np.int64), np.arange(m) * 100
        lead = r.integers(0, reach, m)
        count = np.array([r.integers(1, x + 2) for x in lead])
        raw = []
        for a, n in zip(lead, count):
            v = r.integers(0, 2, n - 1 + length).astype(np.uint8)
            v[a : a + 2] = list(trigger)
            raw.append(v.tobytes())
        off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        got = substring_dedup.decide(group, ids, tag, start, lead, count, np.frombuffer(b"".join(raw), np.uint8), off, length, reach)
        seen = [(ids[p], start[p] + i, (group[p], lead[p] - i, raw[p][i : i + length])) for p in range(m) for i in range(count[p])]
        want = np.zeros_like(got)
        for p in range(m):
            for i in range(count[p]):
                s = (group[p], lead[p] - i, raw[p][i : i + length])
                want[p, i] = any(k == s and (d, at) < (ids[p], start[p] + i) for d, at, k in seen)
        assert (got == want).all()


def test_substrings_odd(odd, none):
    got = by_id(substring_dedup.remove_repeats(odd))
    assert all(r["n_removed"] == 0 for r in got[1] + got[None] + got[4] + got[7]) and got[2][0]["n_removed"] == got[2][0]["n_bytes"]
    assert got[9][0]["kept"] == b"" and got[9][0]["n_spans"] == 1 and bytes(got[3][0]["kept"]) == b" tail"
    assert substring_dedup.remove_repeats(none).count() == 0


def test_packing_round_trip(spark, data, odd, none):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    nasty = ["it's we're  I'll don't", "!'s  \n\n a\n", "你好 x café × naïve", "<|endoftext|>a", "\x00a \x1c", " \n ", "'ll 'x x'", "İ Àſ"]
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").union(odd.where("doc_id IN (4, 5, 6, 7, 8)").select(F.col("doc_id") + 10**6, "text")).union(spark.createDataFrame([(2 * 10**6 + i, t) for i, t in enumerate(nasty)], "doc_id long, text string"))
    pieces = by_id(packing.pack(docs, path, run_tokens=5000))
    windows = collections.defaultdict(list)
    for r in docs.collect():
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1], np.uint32)
        at = 0
        for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
            windows[p["sequence_id"]].append((p["offset"], p["length"]))
        assert at == len(ids)
    pad = total = 0
    for w in windows.values():
        end = 0
        for o, n in sorted(w):
            assert o == end
            end += n
        assert end <= 2048
        total += end
        pad += 0 if end & (end - 1) == 0 else 2048 - end
    assert pad < 0.06 * total  # a partition ends with one short window, and these partitions are small
    assert packing.pack(none, path).count() == 0 and packing.pack(odd, path).where("doc_id IS NULL").count() == 2


def test_packing_marks_sentences_of_every_document():
    tok = packing.PieceTokenizer(packing.default_tokenizer())
    plain = "It ends here. Does it?\nYes!! It's 3.5 x... and on"
    # the same text by the whole-text encoder, which a quote from outside Latin calls
    one = next(kernel.blocks(pa.array([plain, plain + " \u201cq\u201d"])))
    ids, first, close = tok.encode(one)
    n = first[1]
    assert close[:n].sum() == 6 and (ids[n : 2 * n] == ids[:n]).all() and (close[n : 2 * n] == close[:n]).all() and not close[2 * n :].any()
    for text, ends in (("Привет. Как дела?", ["Привет.", "Привет. Как дела?"]), ("你好。再见！", ["你好。", "你好。再见！"]), ("कैसे हो। ठीक", ["कैसे हो।"]), ("كيف حالك؟ نعم", ["كيف حالك؟"]), ("\u00a0a.\n<|endoftext|>b!", ["\u00a0a.", "\u00a0a.\n", "\u00a0a.\n<|endoftext|>b!"])):
        ids, _, close = tok.encode(next(kernel.blocks(pa.array([text]))))
        assert [tok.own.decode(ids[: i + 1].tolist(), skip_special_tokens=False) for i in np.flatnonzero(close)] == ends


def test_packing_is_optimal():
    r = np.random.default_rng(0)
    for _ in range(20):
        pos = np.concatenate([[0], np.cumsum(r.integers(1, 9, 40))])
        kind = r.integers(0, 3, len(pos))
        pen = (0.0, 2.0, 5.0)
        cost = lambda i, j: (0 if (n := int(pos[j] - pos[i])) & (n - 1) == 0 else 16 - n) + pen[kind[j]]
        best = [0.0] + [np.inf] * (len(pos) - 1)
        for j in range(1, len(pos)):
            best[j] = min(best[i] + cost(i, j) for i in range(j) if pos[j] - pos[i] <= 16)
        cuts = packing.best_cuts(pos, kind, 16, pen)
        assert sum(cost(i, j) for i, j in zip(cuts, cuts[1:])) == pytest.approx(best[-1])


def test_decontamination_equals_full_alignment(spark):
    r = random.Random(2)
    items = [(i, " ".join(words(500 + i, 24))) for i in range(12)] + [(50, "too short"), (51, None), (52, "")]
    rows = []
    for i in range(80):
        w = words(i, 200)
        if i % 4 == 0:
            own = items[i % 12][1].split()
            edited = [x for x in (("edit%d" % r.randrange(99) if r.random() < 0.12 else x) for x in own) if r.random() > 0.04]
            at = r.randrange(200)
            w[at:at] = edited
        rows.append((i, " ".join(w).capitalize(), "en", "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t, *_ in rows:
        for k, q in items[:12]:
            a, b = t.lower().split(), q.split()
            h = best = 0
            prev = [0] * (len(a) + 1)
            for y in b:
                row = [0]
                for j, x in enumerate(a):
                    h = max(0, prev[j] + (1 if x == y else -1), prev[j + 1] - 1, row[j] - 1)
                    row.append(h)
                    best = max(best, h)
                prev = row
            if best / len(b) >= 0.5:
                want[i, k] = round(best / len(b), 9)
    got = {(x["doc_id"], x["item_id"]): round(x["score"], 9) for x in decontaminate.matches(table(spark, rows), bench).collect()}
    assert got == want and want
    blocks = {(x["doc_id"], x["item_id"]): round(x["score"], 9) for x in decontaminate.matches(table(spark, rows), bench, block_words=60).collect()}
    assert blocks == want


def test_decontamination_odd(odd, none, spark):
    bench = spark.createDataFrame([(1, " ".join(words(1, 30)))], "item_id long, text string")
    got = by_id(decontaminate.judge(odd, bench))
    assert [r["contaminated"] for r in got[1]] == [True, True] and got[4][0]["contaminated"] is False and got[7][0]["contaminated"] is False
    assert decontaminate.judge(none, bench).count() == 0 and decontaminate.judge(odd, bench.where("false")).where("contaminated").count() == 0
    assert [r["contaminated"] for r in got[None]] == [True, False] or [r["contaminated"] for r in got[None]] == [False, True]
    kept = decontaminate.clean(odd, bench)
    assert kept.columns == odd.columns and sorted(str(r[0]) for r in kept.collect()) == sorted(map(str, [4, 5, 6, 7, None, 8, 9, 10]))
    shared = table(spark, [(1, " ".join(words(1, 120)), "en", "s"), (1, "nothing of it", "en", "s")])
    assert sorted(r["contaminated"] for r in decontaminate.judge(shared, bench).collect()) == [False, True]
    two = spark.createDataFrame([(1, " ".join(words(1, 30))), (1, " ".join(words(1, 60)[30:])), (2, " ".join(words(1, 90)[60:])), (None, " ".join(words(1, 120)[90:]))], "item_id long, text string")
    for block in (1 << 20, 30):
        r = decontaminate.judge(odd.where("doc_id = 2"), two, block_words=block).first()
        assert r["n_items"] == 3 and r["best_item"] in (1, None) and r["best_score"] == 1.0


def test_line_dedup(spark, odd, none):
    many = [(i, f"head line here\nown {i} text\n\nhead line here" if i % 2 else f"own {i} text", "en", f"s{i % 14}") for i in range(200)]
    got = by_id(line_dedup.remove_lines(table(spark, many), min_sites=7))
    assert got[1][0]["n_removed"] == 0 and got[3][0]["text"] == "own 3 text\n" and got[3][0]["n_lines"] == 4 and got[3][0]["n_removed"] == 2
    assert by_id(line_dedup.remove_lines(table(spark, many), min_sites=8))[3][0]["n_removed"] == 0
    wide = [(i, f"common words\nrest {i}", "en", f"s{i}") for i in range(1500)]
    got = line_dedup.remove_lines(table(spark, wide), min_sites=1490).agg(F.sum("n_removed")).first()[0]
    assert got == 1499  # 1500 sites, which the sketch alone could not tell from 1490
    assert line_dedup.remove_lines(table(spark, wide), min_sites=1501).agg(F.sum("n_removed")).first()[0] == 0
    for listed in (0, 1, 1 << 20):  # by joins and by lists
        for sites in (7, 8):
            df = line_dedup.remove_lines(table(spark, many), min_sites=sites, most_listed=listed)
            assert df.agg(F.sum("n_removed"), F.count("*")).first()[:] == ((198 if sites == 7 else 0), 200)
        assert line_dedup.remove_lines(table(spark, wide), min_sites=1490, most_listed=listed).agg(F.sum("n_removed")).first()[0] == 1499
        nameless = line_dedup.remove_lines(odd.withColumn("doc_id", F.lit(None).cast("long")), min_sites=1, most_listed=listed)
        assert nameless.agg(F.sum("n_removed"), F.count("*")).first()[:] == (0, 13)
    kept = by_id(line_dedup.remove_lines(odd, min_sites=2))
    assert kept[4][0]["text"] is None and kept[6][0]["text"] == " \n\t " and len(kept[None]) == 2 and kept[2][0]["text"] == "" and kept[1][0]["n_removed"] == 0
    assert line_dedup.remove_lines(none).count() == 0


def test_license_scan(odd, none, spark):
    assert all(any(k in s for k in license_scan.KEYWORDS) for s in license_scan.RULES.sentences)
    assert {i for r in license_scan.RULES.rules for i in r[2]} <= set(license_scan.RULES.sentences.values())
    t = [(1, "Intro text. Released under the MIT License.\nMore", "en", "s"), (2, "Permission is hereby granted. x", "en", "s"), (3, "LICENSED UNDER CC BY-NC 4.0! Released under the MIT license.", "en", "s"), (4, "you may not use this file except in compliance with the license.\nLicensed under the Apache License, Version 2.0 (the \"License\")", "en", "s")]
    got = {r["doc_id"]: (r["sequence"], r["license"]) for r in license_scan.scan(table(spark, t)).collect()}
    assert got == {1: ("<mit-note>", "MIT"), 2: ("", None), 3: ("<cc-by-nc-4-note><mit-note>", "CC-BY-NC-4.0"), 4: ("<apache-2-terms><apache-2-note>", "Apache-2.0")}
    assert license_scan.scan(odd).count() == 13 and license_scan.scan(none).count() == 0


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""


def test_license_scan_wrapped(spark):
    commented = lambda t, c: "".join(f"{c} {x}".rstrip() + "\n" for x in t.splitlines())
    texts = [MIT, BSD, GPL, commented(MIT, " *"), commented(BSD, "#"), commented(GPL, "//"), MIT.replace("\n", "\r\n"), "All  rights reserved.", "ALL RIGHTS\u00a0RESERVED", "x\nAll\trights\nreserved\ny", "Licensed under the MIT.\nLicense", "all rights\n\nreserved", "we never said all rights reserved", "Note_All rights reserved.\nLicensed under the\nMIT license\nmore"]
    more = {
        "// SPDX-License-Identifier: GPL-2.0-or-later\nint main;": "GPL-2.0",
        "/* SPDX-License-Identifier: Apache-2.0 */": "Apache-2.0",
        "x SPDX-License-Identifier: MIT": None,
        GPL.replace("version 3", "version 2"): "GPL-2.0",
        BSD + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n": "BSD-3-Clause",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may\nnot use this file except in compliance with the License. You may obtain\na copy of the License at\n\n  http://www.apache.org/licenses/LICENSE-2.0\n": "Apache-2.0",
        "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not distributed": "MPL-2.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License.": "CC-BY-SA-4.0",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": "ISC",
    }
    both = license_scan.scan(table(spark, [(1, MIT + "\nSPDX-License-Identifier: GPL-3.0-only\n", "en", "s"), (2, None, "en", "s"), (3, "no notice", "en", "s")])).orderBy("doc_id").collect()
    assert [r["licenses"] for r in both] == [["GPL-3.0", "MIT"], [], []] and both[0]["license"] == "GPL-3.0"
    assert [r["license"] for r in license_scan.scan(table(spark, [(i, t, "en", "s") for i, t in enumerate(more)])).orderBy("doc_id").collect()] == list(more.values())
    got = [r["license"] for r in license_scan.scan(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).orderBy("doc_id").collect()]
    assert got == ["MIT", "BSD-2-Clause", "GPL-3.0", "MIT", "BSD-2-Clause", "GPL-3.0", "MIT", "proprietary", "proprietary", "proprietary", None, None, None, "MIT"]


def test_language_id_held_out(spark):
    data = "/root/testdata/sf0.01"
    got = queries.queries()["op3_language_id"](spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.97 and got["score"].between(0, 1).all()


def test_language_id_odd(odd, none):
    model = language_id.train(odd)
    got = by_id(language_id.predict(odd, model))
    assert got[4][0]["lang_pred"] == got[5][0]["lang_pred"] == got[6][0]["lang_pred"] == "und" and got[3][0]["lang_pred"] in ("en", "fr") and len(got[None]) == 2
    assert language_id.predict(odd, language_id.train(none)).where("lang_pred <> 'und'").count() == 0 and language_id.predict(none, model).count() == 0
    assert len(model.used) < language_id.BUCKETS / 2
    with pytest.raises(ValueError, match="languages"):
        language_id.train(odd, most_languages=1)


def test_language_id_counts_by_the_block():
    texts = ["", None, "12 34", "Hello,  World\n\nagain", "ÇA VA? Straße ΟΔΟΣ", "a", " a", "x" * 300000, "日本 語 Ünï", *(" ".join(words(i, 30)) for i in range(150))]
    rows = [(c.at[c.row == i], c.count[c.row == i]) for c in language_id.chunk_counts(texts) for i in range(c.n)]
    assert len(rows) == len(texts)
    for (at, count), t in zip(rows, texts):
        want = language_id.gram_counts(t)
        assert at.tolist() == want[0].tolist() and count.tolist() == want[1].tolist()


def test_language_id_equals_a_plain_loop():
    """Follow-the-regularised-leader coordinate by coordinate, and the temperature by a fine grid."""
    import math

    r = random.Random(4)
    samples = [(*language_id.gram_counts(" ".join(r.choice(v) for _ in range(8))), y) for _ in range(60) for y, v in (("a", ["ana", "bana", "tam"]), ("b", ["tom", "bono", "ana"]))]
    idf = np.linspace(1, 2, language_id.BUCKETS)
    alpha, beta, l1, l2 = 1.0, 1.0, 0.05, 0.05
    got = language_id.fit(samples, idf, alpha, beta, l1, l2, passes=2, seed=3)
    order = np.random.default_rng(3).permutation(len(samples))
    held, learn = [samples[i] for i in order[:12]], [samples[i] for i in order[12:]]
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(k):
        return 0.0 if abs(z[k]) <= l1 else -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    def features(at, count):
        v = {int(i): (1 + math.log(c)) * idf[i] for i, c in zip(at, count)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {i: x / norm for i, x in v.items()} | {-1: 1.0}

    for _ in range(2):
        for at, count, y in learn:
            x = features(at, count)
            w = {(c, i): weight((c, i)) for c in "ab" for i in x}
            s = {c: sum(w[c, i] * x[i] for i in x) for c in "ab"}
            total = sum(math.exp(v) for v in s.values())
            for c in "ab":
                slope = math.exp(s[c]) / total - (c == y)
                for i in x:
                    g = slope * x[i]
                    z[c, i] += g - (math.sqrt(n[c, i] + g * g) - math.sqrt(n[c, i])) / alpha * w[c, i]
                    n[c, i] += g * g
    dense = np.zeros((2, language_id.BUCKETS))
    dense[:, got.used] = got.weights
    for j, c in enumerate("ab"):
        assert got.bias[j] == pytest.approx(weight((c, -1)))
        for i in range(0, language_id.BUCKETS, 7):
            assert dense[j, i] == pytest.approx(weight((c, i)), abs=1e-9)
    logits = [({c: sum(weight((c, i)) * v for i, v in features(at, count).items()) for c in "ab"}, y) for at, count, y in held]
    loss = lambda t: sum(math.log(sum(math.exp(v / t) for v in s.values())) - s[y] / t for s, y in logits)
    grid = np.exp(np.linspace(math.log(0.25), math.log(20), 4000))
    assert loss(got.temperature) <= min(loss(t) for t in grid) + 1e-6


def test_quality_held_out(spark):
    data = "/root/testdata/sf0.01"
    got = queries.queries()["op1_quality"](spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.9 and (got[got.quality == 0]["predicted"] == 0).mean() > 0.9


def test_quality_equals_the_densities(spark):
    """Scores from Gaussian densities written out with determinants and inverses, shrunk by the formula over single rows."""
    r = np.random.default_rng(5)
    d = len(quality.FEATURES)
    mix = r.normal(size=(2, d, d))
    y = (r.random(300) < 0.4).astype(int)
    x = np.stack([mix[k] @ r.normal(size=d) * 3 + 5 * k + 100 for k in y])
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, y))], "id long, x array<double>, label int").repartition(7)
    model = quality.fit(df)
    scale = x.std(0)
    logs, shares = [], []
    for k in (0, 1):
        own = (x[y == k] - x[y == k].mean(0)) / scale
        cov = sum(np.outer(v, v) for v in own) / len(own)
        level = np.trace(cov) / d
        noise = sum(((np.outer(v, v) - cov) ** 2).sum() for v in own) / len(own) ** 2
        share = min(1.0, max(0.02, noise / ((cov - level * np.eye(d)) ** 2).sum()))
        shrunk = (1 - share) * cov + (share * level + 1e-6) * np.eye(d)
        far = (x - x[y == k].mean(0)) / scale
        logs.append(np.log((y == k).mean()) - 0.5 * np.log(np.linalg.det(shrunk)) - 0.5 * np.einsum("ni,ij,nj->n", far, np.linalg.inv(shrunk), far))
        shares.append(share)
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    got = {q["id"]: q["score"] for q in quality.score(df, model).collect()}
    assert model.shares == pytest.approx(shares) and 0.02 < min(shares) < 1
    assert [got[i] for i in range(300)] == pytest.approx(want.tolist(), abs=1e-9)


def test_quality_odd(odd, none):
    x = quality.measure(odd)
    assert x.count() == 13 and quality.measure(none).count() == 0
    flat = quality.score(x, quality.fit(x.withColumn("label", F.lit(1))))
    assert {r["score"] for r in flat.collect()} == {1.0}
    assert {r["score"] for r in quality.score(x, quality.fit(x.where("false").withColumn("label", F.lit(1)))).collect()} == {0.5}
    two = quality.score(x, quality.fit(x.withColumn("label", (F.xxhash64("x") % 2 == 0).cast("int"))))
    assert all(0 <= r["score"] <= 1 for r in two.collect())


def test_pipeline(spark):
    import corpus_pipeline as P

    rows = [(i, " ".join(words(i, 80)), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s9") for i in range(5)] + [(200, " ".join(["qué", "día", "señor"] * 40), "es", "s1"), (201, "12 34", "en", "s1")]
    names = "doc_id text lang source n_chars".split()
    docs = table(spark, rows).select(names)
    first = P.language(spark, docs, "")
    assert {r[0] for r in docs.subtract(first).collect()} == {201} and first.columns == names
    assert P.lines(spark, first, "").columns == names
    near = P.near(spark, first, "")
    assert {r[0] for r in near.select("doc_id").collect()} == {*range(40), 200} and near.columns == names
    clean = P.benchmark(spark, near, "/root/testdata/sf0.001")
    assert clean.count() == 41 and clean.columns == names
    assert {r[0] for r in P.pack(spark, clean, "").select("doc_id").distinct().collect()} == {*range(40), 200}


def test_pipeline_on_odd_rows(spark, odd, none):
    """Null and empty texts, repeated ids, a very long text and an empty table, stage by stage."""
    import corpus_pipeline as P

    names = "doc_id text lang source n_chars".split()
    docs = odd.select(names).withColumn("n_chars", F.col("n_chars").cast("int"))
    for rows, least, most in ((docs, {1, 7, None}, {1, 7, 8, 10, None}), (none.select(names), set(), set())):
        for name, stage in P.STAGES[:-1]:
            rows = stage(spark, rows, "/root/testdata/sf0.001")
            assert rows.columns == names, name
        pieces = P.STAGES[-1][1](spark, rows, "")
        kept = {r[0] for r in rows.select("doc_id").distinct().collect()}
        assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == kept
        assert least <= kept <= most
