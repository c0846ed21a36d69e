"""Periodic runs, WARC archives and spelling variants against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from papersieve.llm import periodic, queries, spelling, warc
from papersieve.llm.hashing import mix
from papersieve.session import work_path

SF = "/root/testdata/sf0.001"


# Periodic runs


def brute_runs(words, least=24, exponent=3):
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w, out = np.array([names[x] for x in words], np.int64), []
    for q in range(1, len(w) // exponent + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = b - a + q
            if length >= max(least, exponent * q):
                own = w[a : a + length]
                if not any((own[r:] == own[:-r]).all() for r in range(1, q)):
                    out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def random_words(rng):
    if rng.random() < 0.3:
        return [rng.randint(0, 2) for _ in range(rng.randint(0, 100))]
    out = []
    for _ in range(rng.randint(1, 4)):
        period = [rng.randint(0, 3) for _ in range(rng.randint(1, 14))]
        out += period * rng.randint(1, 9) + period[: rng.randint(0, len(period))] + [rng.randint(0, 5) for _ in range(rng.randint(0, 4))]
    return out


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        texts = [random_words(rng) for _ in range(rng.randint(1, 8))]
        codes = mix(np.array([x for t in texts for x in t], np.uint64))
        first = np.cumsum([0, *map(len, texts)])
        for least, exponent in ((24, 3), (6, 2), (10, 3)):
            got = periodic.runs_of(codes, first, least, exponent)
            assert [got.get(i, []) for i in range(len(texts))] == [brute_runs(t, least, exponent) for t in texts]


def test_periodic_query_equals_brute_force(spark):
    rows = queries.op11_periodic_runs(spark, SF).collect()
    want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(want) and any(r["n_runs"] for r in rows)
    for r in rows:
        assert tuple(r) == brute_row(r["doc_id"], want[r["doc_id"]])


def test_periodic_edge_cases(spark):
    texts = [
        None, "", " \t\n", "one", "x " * 24, "x " * 23, "a b c " * 8 + "d", "a b\x1fc " * 30, "é\nü  " * 40, "a b " * 20 + "a b c " * 20,
    ]
    rows = [(i, t, 7, "r") for i, t in enumerate(texts)] + [(3, "one", 0, ""), (None, "z " * 50, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string")
    got = {(r["doc_id"], r["collapsed"]): [tuple(x) for x in r["runs"]] for r in periodic.collapse(docs).collect()}
    assert got[0, ""] == got[1, ""] == got[2, ""] == [] and got[3, "one"] == []
    assert got[4, "x"] == [(0, 24, 1)] and got[5, " ".join("x" * 23)] == []
    assert got[6, "a b c d"] == [(0, 24, 3)] and got[None, "z"] == [(0, 50, 1)]
    assert got[7, "a b\x1fc"] == [(0, 30, 1)] and got[8, "é ü"] == [(0, 80, 2)]
    assert (9, "a b c") in got and len(got) == 11
    assert periodic.collapse(docs).count() == 12 and periodic.collapse(docs.limit(0)).count() == 0


def test_very_long_periodic_text():
    codes = mix(np.arange(300_000, dtype=np.uint64) % np.uint64(40_000))
    assert periodic.runs_of(codes, np.array([0, len(codes)])) == {0: [(0, 300_000, 40_000)]}
    same = np.full(200_000, 5, np.uint64)
    assert periodic.runs_of(same, np.array([0, len(same)])) == {0: [(0, 200_000, 1)]}


# WARC archives


def brute_records(rows, least=100):
    groups = defaultdict(list)
    for i, (page_id, html) in enumerate(rows):
        groups[html or ""].append((page_id is None, page_id, i))
    out = Counter()
    for html, members in groups.items():
        raw = html.encode()
        for place, (_, page_id, _) in enumerate(sorted(members, key=lambda m: (m[0], m[1] or 0, m[2]))):
            again = place > 0 and len(raw) >= least
            first = min(members, key=lambda m: (m[0], m[1] or 0))[1]
            digest = hashlib.sha256(raw).hexdigest()
            out[page_id, len(raw), digest, "revisit" if again else "response", first if again else None] += 1
    return out


def test_warc_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    assert Counter(tuple(r) for r in queries.op12_warc(spark, SF).collect()) == brute_records([tuple(r) for r in rows])


def test_warc_edge_cases(spark):
    long, exact, short = "é" * 5000, "y" * 100, "z" * 99
    rows = [(9, None, long), (2, "http://a b/\r\nX: 1", long), (5, "ü://", long), (5, "u", long), (None, "n", long), (1, "", None), (3, "u", "")]
    rows += [(20, "u", exact), (10, "u", exact), (30, "u", short), (29, "u", short), (None, "u", "q" * 200), (7, "u", "WARC/1.1\r\n\r\n\r\n" * 30)]
    pages = spark.createDataFrame([(*r, "f") for r in rows], "page_id long, url string, html string, file string").repartition(3)
    files = warc.capture(pages, work_path(spark, "warc"))
    kept = warc.deduplicate(files, work_path(spark, "warc"))
    got = warc.resolve(kept)
    number = lambda c: F.col(c).cast("long")
    narrow = got.select(number("key"), "payload_bytes", "payload_digest", "record_type", number("refers_to_key"))
    assert Counter(tuple(r) for r in narrow.collect()) == brute_records([(r[0], r[2]) for r in rows])
    uris = {r["target_uri"] for r in got.collect()}
    assert {"about:blank", "http://a%20b/%0D%0AX:%201", "%C3%BC://"} <= uris
    ids = [r["record_id"] for r in got.collect()]
    assert len(set(ids)) == len(ids) == len(rows)
    # Archives that hold revisits already stay as they are, with new ids.
    again = warc.resolve(warc.deduplicate(kept, work_path(spark, "warc")))
    assert Counter((r["key"], r["record_type"], r["refers_to_key"]) for r in again.collect()) == Counter(
        (r["key"], r["record_type"], r["refers_to_key"]) for r in got.collect()
    )
    assert not set(ids) & {r["record_id"] for r in again.collect()}
    empty = warc.deduplicate(warc.capture(pages.limit(0), work_path(spark, "warc")), work_path(spark, "warc"))
    assert empty.count() == 0 and warc.resolve(empty).count() == 0


def test_warc_records_parse():
    raw = warc.record([("WARC-Type", "response"), ("X", None), ("Y", "a: b")], b"body\r\n\r\n")
    assert warc.parse(raw) == ({"warc-type": "response", "y": "a: b", "content-length": "8"}, b"body\r\n\r\n")
    zipped = [zlib.compressobj(wbits=31) for _ in range(3)]
    whole = b"".join(z.compress(bytes([i]) * 100_000 * i) + z.flush() for i, z in enumerate(zipped))
    assert [len(m) for m in warc.members(whole)] == [0, 100_000, 200_000]
    with pytest.raises(ValueError):
        list(warc.members(whole[:-1]))


# Spelling variants


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters, near, form = sorted({c for w in words for c in w}), {}, {}
    for w in words:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = (edits & words.keys()) - {w}
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_spelling_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op13_spelling_variants(spark, folder).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(rows) and any(r[1] for r in got)


def test_spelling_edge_cases(spark, monkeypatch):
    rng = random.Random(5)
    base = ["".join(rng.choice("abÿ") for _ in range(rng.randint(7, 9))) for _ in range(40)] + ["a" * 300, "a" * 301, "aaaaaaa", "aaaaaaaa"]
    rows = [(i, " ".join(rng.choice(base) for _ in range(rng.randint(0, 200)))) for i in range(40)]
    rows += [(108, "chained " * 1200), (109, "chainedd " * 110), (110, "chaineddd " * 10), (112, "chainedddd chainedddd")]
    rows += [(None, "LONGWORD longword LONGÀORD longàord"), (5, None), (6, ""), (7, "×÷×÷×÷× " * 3)]
    docs = spark.createDataFrame([(*r, "w", 3) for r in rows], "doc_id long, text string, word string, n int")
    words = spelling.vocabulary(spelling.damaged(spelling.letter_runs(docs)))
    want = brute_variants(rows)
    assert {tuple(r) for r in spelling.group(words).collect()} == want
    assert ("chaineddd", "chainedd", "chained") in {r[:3] for r in want}
    monkeypatch.setattr(spelling, "MOST_BITS", 64)
    assert {tuple(r) for r in spelling.group(words).collect()} == want
    assert spelling.group(words.limit(0)).count() == 0


def test_filter_knows_all_keys(spark):
    keys = mix(np.arange(3000, dtype=np.uint64)).view(np.int64)
    known = spelling.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), len(keys))
    assert spelling.passes(known, keys.view(np.uint64)).all()
    assert spelling.passes(known, mix(np.arange(10_000, 30_000, dtype=np.uint64))).mean() < 0.02


def test_neighbourhoods_are_whole_and_hold_each_string_once():
    rng = random.Random(2)
    for n in (1, 2, 5, 8):
        symbols = np.array([[rng.randrange(spelling.SYMBOLS) for _ in range(n)] for _ in range(6)])
        symbols[0] = 3
        key = lambda s: int(spelling.reduced_key(np.array([s], np.int64).reshape(1, -1))[0])
        rows, keys = spelling.neighbourhood(symbols)
        for i, word in enumerate(symbols.tolist()):
            every = range(spelling.SYMBOLS)
            near = {tuple(word)} | {tuple(word[:k] + [s] + word[k + 1 :]) for k in range(n) for s in every}
            near |= {tuple(word[:k] + [s] + word[k:]) for k in range(n + 1) for s in every}
            near |= {tuple(word[:k] + word[k + 1 :]) for k in range(n)} if n > 1 else set()
            assert sorted(keys[rows == i].tolist()) == sorted(map(key, near))
