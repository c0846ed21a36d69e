"""Jaccard join against brute force; classifiers on held-out rows; edge cases; the pipeline."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from papersieve.llm import components, jaccard_join, language, packing, partenum, quality, queries, sampling, toxicity
from papersieve.llm.base import text_buffers
from papersieve.llm.encoding import public_tokenizer
from papersieve.llm.sampling import fold, outside_fold

SF_DIR = "/root/testdata/sf0.01"


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components_by_hand(rows):
    sets, parent = {}, {}
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(text))
            parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def random_corpus(seed, n=140):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 3)))
    passage = [word() for _ in range(25)]
    base = [word() for _ in range(90)]
    rows = [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "a b c d"), (506, "a b c d e"), (None, "a b c d e")]
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = word()
        elif kind < 0.8:
            words = [word() for _ in range(rng.randint(1, 60))] + passage * rng.randint(0, 1)
        else:
            words = rng.choice(rows)[1] or "z"
            words = words.split() + ["q"] * rng.randint(0, 2)
        rows.append((i, (" " if i % 2 else "\n ").join(words).swapcase() if i % 5 == 0 else " ".join(words)))
    return rows + [rows[9], (10, rows[20][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    rows = random_corpus(seed)
    table = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, component_id int, node string")
    found = [tuple(r) for r in jaccard_join.join(table).collect()]
    want = components_by_hand(rows)
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(found, key=key) == sorted(((i, len(shingles(t)), want.get(i)) for i, t in rows), key=key)
    kept = jaccard_join.keep_one(table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, root in want.items() if i == root} | {None}


def test_join_without_broadcasts_or_remembered_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(jaccard_join, "SEEN_SETS", 0)
    monkeypatch.setattr(jaccard_join, "PER_SALT", 3)
    rows = random_corpus(3, 60)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_by_hand(rows)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.join(table).collect()} == {**want, None: None}


def test_join_of_empty_table(spark):
    assert jaccard_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(11)
    common = np.sort(rng.integers(0, 2**64 - 1, 400, dtype=np.uint64))
    for _ in range(1500):
        n = int(rng.integers(1, 40)) if rng.random() < 0.6 else int(rng.integers(40, 400))
        pool = np.unique(np.concatenate([rng.integers(0, 2**64 - 1, 2 * n + 5, dtype=np.uint64), common[: int(rng.integers(0, n + 1))]]))
        rng.shuffle(pool)
        cut, more = int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 4 + 1))
        a, b = pool[:n], np.concatenate([pool[cut:n], pool[n : n + more]])
        if len(b) and 100 * (n - cut) >= 80 * (n + more):
            for held in (None, common):
                assert len(np.intersect1d(partenum.signatures(a, held), partenum.signatures(b, held)))


def test_parities_bound_the_difference(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PARITY_BITS", ((20, 512), (80, 2048), (1 << 62, 8192)))
    rng = np.random.default_rng(5)
    for _ in range(300):
        pool = rng.integers(0, 2**64 - 1, 400, dtype=np.uint64)
        a, b = np.unique(pool[: rng.integers(1, 200)]), np.unique(pool[rng.integers(0, 30) : rng.integers(31, 200)])
        x, y = jaccard_join.parities(a), jaccard_join.parities(b)
        while len(x) != len(y):
            x, y = (jaccard_join.folded(x), y) if len(x) > len(y) else (x, jaccard_join.folded(y))
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))
    same = np.unique(pool)
    assert (jaccard_join.parities(same) == jaccard_join.parities(same.copy())).all()


def test_family_just_below_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PARITY_BITS", ((40, 512), (70, 2048), (1 << 62, 8192)))
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(0, 80, 6), 1 + (i % 3 == 0)):
            words[k] = f"x{i}.{k}"
        rows.append((i, " ".join(words + [f"tail{i % 6}.{k}" for k in range(i % 7)])))
    want = components_by_hand(rows)
    assert 1 < len(set(want.values())) < 60
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.join(table).collect()} == want


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def labelled(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_quality_on_held_out_rows(spark):
    documents, labels = labelled(spark)
    found = queries.op2_quality_classifier(spark, SF_DIR).join(labels, "doc_id").filter("held_out").toPandas()
    assert found.columns.tolist()[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert (found["predicted"] == found["quality"]).mean() > 0.97
    assert not set(outside_fold(labels, 3, 1).toPandas()["doc_id"]) & set(found["doc_id"])


def test_language_on_held_out_rows(spark):
    documents, _ = labelled(spark)
    found = queries.op10_language_id(spark, SF_DIR).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (found["lang_pred"] == found["lang"]).mean() > 0.97 and found["rejected"].mean() < 0.02


def test_language_of_odd_numbers_long_texts_and_many_languages(spark, monkeypatch):
    documents, _ = labelled(spark)
    model = language.fit(documents)
    names, score, rejected = model.judge(pa.array(["½ ²", "Ⅷ ⅳ", "١٢٣", "_ -", "ª", None]))
    assert names[:4] == ["und"] * 4 and names[4] != "und" and names[5] == "und" and score[0] == 0.0
    text = documents.filter("lang = 'de'").first()["text"]
    texts = pa.array([text, text * 40, "É" * 3001, "x", text[:50]])
    whole = model.scores(*text_buffers(texts))
    monkeypatch.setattr(language, "STEP", 1 << 13)
    assert np.allclose(whole, model.scores(*text_buffers(texts)))
    many = language.Model(tuple(f"l{i:03d}" for i in range(200)), np.random.default_rng(1).normal(size=(language.BUCKETS, 200)), np.zeros(200), 0.0)
    assert len(many.judge(pa.array([text * 500, "a"]))[0]) == 2


def test_samples_take_an_id_once(spark):
    documents = spark.createDataFrame([(i % 7, f"text {i}", "en") for i in range(70)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i % 7, i % 2) for i in range(70)], "doc_id long, quality int")
    chosen = sampling.sampled_labels(labels, "quality", "doc_id", 1000)
    rows = sampling.one_text(documents, chosen, "doc_id", "text").collect()
    assert sorted((r["k"], r["y"], r["t"]) for r in rows) == [(i, 1, min(f"text {j}" for j in range(i, 70, 7))) for i in range(7)]
    some = sampling.sample_by_class(documents.select("doc_id", "lang"), "doc_id", "lang", 100, 3)
    assert some.count() <= 7


def test_toxicity_on_held_out_english(spark):
    documents, labels = labelled(spark)
    found = queries.op9_toxicity(spark, SF_DIR).join(labels, "doc_id").join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    found = found[found["lang"] == "en"]
    assert (found["predicted"] == found["toxic"]).mean() > 0.97


ODD = [(1, None), (2, ""), (3, "123 !!"), (4, "the " * 60_000), (5, "x"), (5, "x"), (None, "the and of")]


def test_classifiers_on_odd_rows(spark):
    table = spark.createDataFrame([(*r, 0.5, "k") for r in ODD], "doc_id long, text string, score double, k string")
    documents, labels = labelled(spark)
    model = language.fit(documents)
    got = [tuple(r) for r in language.identify(table, model).collect()]
    assert [(g[1], g[2], g[3]) for g in got[:3]] == [("und", 0.0, True)] * 3 and got[3][1] == "en" and got[4] == got[5] and len(got) == 7
    assert {r["doc_id"] for r in language.keep_identified(table, model).collect()} <= {4, 5, None}
    assert {r[1] for r in language.identify(table, language.fit(documents.limit(0))).collect()} == {"und"}
    scored = [tuple(r) for r in quality.score(table, quality.fit(documents, labels)).collect()]
    assert scored[0][1] == scored[1][1] and all(0 <= s[1] <= 1 for s in scored) and len(scored) == 7
    assert {r["score"] for r in quality.score(table, quality.fit(documents, labels.limit(0))).collect()} == {0.5}
    lexicon = toxicity.Lexicon({"idiot": 5.0}, power=0.1, slope=4.0, bias=-3.0)
    scored = toxicity.score(table, lexicon).collect()
    assert scored[0]["score"] == scored[1]["score"] < 0.5 and len(scored) == 7
    assert toxicity.fit(documents, labels.limit(0)).weights == {}
    none = table.limit(0)
    for empty in (language.identify(none, model), quality.score(none, quality.train([])), toxicity.score(none, lexicon)):
        assert empty.count() == 0


def test_quality_scores_do_not_depend_on_the_batch():
    texts = ["A b c %% c c", None, "", "DEF!! GHI!!", "é ü 12 12"]
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=quality.BUCKETS), 0.1)
    from papersieve.llm.base import text_buffers

    whole = model.scores(*text_buffers(pa.array(texts)))
    alone = [model.scores(*text_buffers(pa.array([t], pa.string())))[0] for t in texts]
    assert np.allclose(whole, alone)
    by_hand = []
    for text in texts:
        buckets, values = quality.sparse(text)
        by_hand.append(1 / (1 + np.exp(-(model.bias + (model.weights[buckets] * values).sum()))))
    assert np.allclose(whole, by_hand)


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({toxicity.fold_text("idiot"): 5.0, toxicity.fold_text("trash"): 4.0, toxicity.fold_text("loser"): 3.0}, ("trash can",))
    weigh = lambda t: lexicon.weigh(t)[0]
    for text in ("an IDIOT", "an 1d10t", "іdіоt!", "i​diot", "ïdiöt", "id!ot", "idiots", "%%idiot$$$"):
        assert weigh(text) == 5.0, text
    assert weigh("empty the trash can now") == 0.0 and weigh("trash can trash") == 4.0 and weigh("l0ser") == 3.0
    assert weigh("closer") == 0.0 and weigh("") == weigh(None) == 0.0


def test_copies_of_a_toxic_text_do_not_enter_the_lexicon():
    toxic = [f"w{i} idiot v{i}" for i in range(40)] + ["one idiot wrote strange unique things"] * 30
    clean = [f"w{i} thing v{i}" for i in range(300)]
    counts, neighbours = {}, {}
    for entry in {e for t in toxic for e in toxicity.beginnings(set(toxicity.fold_text(t).split()))}:
        held = [sum(entry in toxicity.beginnings(set(toxicity.fold_text(t).split())) for t in side) for side in (toxic, clean)]
        counts[entry] = (held[0], held[1], float(np.log((held[0] + 0.5) / 71) - np.log((held[1] + 0.5) / 301)))
        neighbours[entry] = {b for t in toxic for e, b in toxicity.neighbours_of(t, {entry})}
    assert set(toxicity.choose(counts, neighbours, 70 / 370)) == {"idiot"}


def test_folds(spark):
    import zlib

    rows = spark.range(200)
    got = {r[0]: r[1] for r in rows.select("id", fold(rows["id"], 5)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(200)}


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    labels = docs.sparkSession.read.parquet(f"{SF_DIR}/labels.parquet")
    bench = docs.sparkSession.read.parquet(f"{SF_DIR}/benchmark.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    at, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = at
        at = stage(spark, at, SF_DIR).cache()
        kept[name] = ({r["doc_id"] for r in before.collect()}, {r["doc_id"] for r in at.collect()})
        if name != "best-fit packing":
            assert at.columns == docs.columns
    lexicon = toxicity.fit(docs, outside_fold(labels, 5, 0))
    before, after = kept["toxicity"]
    assert after == {i for i in before if lexicon.scores(*([x] for x in lexicon.weigh(text[i])))[0] < 0.5}
    before, after = kept["language ID"]
    assert after == before
    before, after = kept["n-gram Jaccard join"]
    rows = [(i, text[i]) for i in before]
    assert after <= before and len(before) - len(after) < 0.2 * len(before)
    firsts = {}
    for i, t in sorted(rows):
        firsts.setdefault(frozenset(shingles(t)), i)
    assert all(i in set(firsts.values()) for i in after)
    before, after = kept["benchmark decontamination"]
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    spans = set()
    for r in bench.collect():
        own = words(r["text"])
        spans |= {tuple(own[i : i + 10]) for i in range(len(own) - 9)} if len(own) >= 10 else {tuple(own)}
    longer, shorter = {s for s in spans if len(s) == 10}, [s for s in spans if 0 < len(s) < 10]
    hit = lambda w: any(tuple(w[i : i + 10]) in longer for i in range(len(w) - 9)) or any(
        tuple(w[i : i + len(s)]) == s for s in shorter for i in range(len(w) - len(s) + 1)
    )
    assert after == {i for i in before if not hit(words(text[i]))}
    before, after = kept["best-fit packing"]
    assert after == before
    found = at.collect()
    own = public_tokenizer("byte_bpe_50k.json")
    assert packing.encoder(own) and sum(r["length"] for r in found) == sum(
        len(packing.encoder(own).encode(text[i])) // 4 + 1 for i in before
    )


def test_language_features_come_to_the_driver_task_by_task(spark, monkeypatch):
    rows = [(i, text, lang) for i in range(6) for text, lang in ((f"the house of the king {i}", "en"), (f"das Haus und der Garten {i}", "de"))]
    docs = spark.createDataFrame([(n, *row[1:]) for n, row in enumerate(rows)], "doc_id long, text string, lang string")

    def gathered(self):
        raise AssertionError("all features at once in the driver")

    for name in ("toPandas", "toArrow"):
        monkeypatch.setattr(type(docs), name, gathered)
    model = language.fit(docs)
    assert model.languages == ("de", "en")
