"""The training-data operators on small rows, against brute force where there is an answer."""

import hashlib
import math
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardlake.llm import common, language, media, mixing, neighbours, packing, quality, simhash, tokens, toxicity, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "b", 0), (3, " \t\n", "en", "b", 3), (4, "one two  three", "en", "a", 14), (4, "one two  three", "en", "a", 14), (None, "x", None, "a", 1), (6, "w " * 30000, "de", None, 60000)]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("clash"), "size": F.lit("clash"), "media": F.lit(1)})


def test_mix_reaches_targets(spark):
    out = mixing.op2_mixing(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert len(out) == len(docs) and (out["taken"] <= 3 * out["size"]).all()
    sizes = docs["text"].fillna("").map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert dict(zip(docs["doc_id"], sizes)) == dict(zip(out["doc_id"], out["size"]))
    whole = sizes.groupby(docs["source"]).sum().sort_index()
    weights, target, free = [(5, 2, 1)[i % 3] for i in range(len(whole))], {}, set(range(len(whole)))
    while True:  # the excess is shared again until none is above
        left = whole.sum() - sum(target.values())
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 3 * whole.iloc[i]]
        if not over:
            break
        target |= {i: 3 * whole.iloc[i] for i in over}
        free -= set(over)
    target |= share
    got = out.merge(docs[["doc_id", "source"]], on="doc_id").groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    for i, name in enumerate(whole.index):
        assert got.loc[name, "target"] == pytest.approx(target[i]) and abs(got.loc[name, "taken"] - target[i]) <= 1
    assert out.sort_values("doc_id").equals(mixing.op2_mixing(spark, SF).toPandas().sort_values("doc_id").set_axis(out.sort_values("doc_id").index))


def test_mix_of_odd_rows(spark):
    out = mixing.mix(docs_of(spark, ODD))
    assert out.stream.count() == len(ODD)
    taken = out.pieces.groupBy("key").agg(F.sum("length").alias("n"))
    assert {r["key"]: r["n"] for r in taken.collect()} == {r["key"]: r["goal"] for r in out.stream.where("goal > 0").collect()}
    assert mixing.mixed_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_tokens_equal_the_tokenizer():
    ids = tokens.PackedIds(tokens.tokenizer_path())
    for text in ["", "Don't we'LL it's", "İstanbul ΣΑΣ", "a<|endoftext|>b", "x\xa0y \x85z\x1cq", "é É 日本 ½", "12a3,b! ß", "tab\there"]:
        assert ids.of(text) == array("I", ids.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_length_histogram(spark):
    rows = tokens.length_histogram(docs_of(spark, ODD[:6] + [(8, "a b c d", "en", "a", 7)])).orderBy("n_tokens").collect()
    lengths = sorted([0, 0, 0, 3, 3, 1, 4])
    assert [(r["n_tokens"], r["documents"]) for r in rows] == [(0, 3), (1, 1), (3, 2), (4, 1)]
    for r in rows:
        n = r["n_tokens"]
        assert r["documents_from"] == sum(x >= n for x in lengths) and r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["kept_at_limit"] == sum(min(x, n) for x in lengths) and r["quantile"] == pytest.approx(sum(x <= n for x in lengths) / 7)


def test_packing_is_lossless(spark):
    docs = docs_of(spark, [(i, t, None, None, 0) for i, t in enumerate([None, "", "word " * 9000, *[f"some text {k} " * (k % 200) for k in range(300)]])])
    out = packing.pack(docs.coalesce(2)).toPandas()
    ids = tokens.PackedIds(tokens.tokenizer_path())
    for r in docs.select("doc_id", "text").collect():
        full = ids.of(r["text"]) + (2).to_bytes(4, "little")
        own = out[out["doc_id"] == r["doc_id"]].sort_values("start")
        at = 0
        for p in own.itertuples():
            assert p.start == at and p.doc_tokens == len(full) // 4 and p.ids_crc32 == zlib.crc32(full[4 * at : 4 * (at + p.length)])
            at += p.length
        assert at == len(full) // 4
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 4096
        assert s["length"].sum().bit_count() == 1
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_simhash_against_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and then runs far away into the deep dark forest".split()
    rows = [(100 - i, " ".join(base * 40 + [f"w{i}"]), None, None, 0) for i in range(8)] + [(500 + i, " ".join(f"v{i}{k}" for k in range(60)), None, None, 0) for i in range(20)]
    out = simhash.near_duplicates(docs_of(spark, rows + ODD)).toPandas()
    fp = out["fingerprint"].map(lambda x: int(x, 16)).tolist()
    group = list(range(len(fp)))
    for i in range(len(fp)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = defaultdict(lambda: math.inf)
    for g, d in zip(group, out["doc_id"]):
        first[g] = min(first[g], d) if d == d else first[g]
    for g, c in zip(group, out["component_id"]):
        assert (c != c and first[g] == math.inf) or c == first[g]
    assert len(out) == len(rows) + len(ODD) and simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_covering_finds_every_near_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.int64)
    b = a.copy()
    for i in range(len(b)):
        for k in rng.choice(63, 4, replace=False):
            b[i] ^= np.int64(1) << np.int64(k)
    fp = np.concatenate([a, b])
    row, anchor, own = simhash.near_anchors(fp)
    where = defaultdict(set)
    home = defaultdict(set)
    for r, x, o in zip(row, anchor, own):
        where[r].add(x)
        if o:
            home[r].add(x)
    assert all(len(h) == 2 for h in home.values())
    assert all(home[i] & where[i + 300] for i in range(300))


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 16))
    rows = [(i, [float(v) for v in x[i]]) for i in range(400)] + [(1000 + i, [1.0] * 16) for i in range(40)] + [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, []), (None, [1.0] * 16), (0, [float(v) for v in x[0]])]
    out = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50).toPandas()
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:440]}
    hit = total = 0
    for q in [i for i in good if i % 50 == 0]:
        best = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        got = out[out["query_id"] == q].sort_values("rank")
        assert list(got["rank"]) == list(range(1, len(got) + 1)) and q not in set(got["vec_id"])
        hit, total = hit + len({i for _, i in best} & set(got["vec_id"])), total + 5
    assert hit / total >= 0.9
    assert list(out[out["query_id"] == 1000].sort_values("rank")["vec_id"]) == [1001, 1002, 1003, 1004, 1005]


def test_neighbours_in_many_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BUCKET", 16)  # as many buckets as a table 16 times as large would have
    x = np.random.default_rng(4).normal(size=(12_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = neighbours.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), every=100).toPandas()
    near = x[::100] @ x.T
    near[np.arange(120), np.arange(0, 12_000, 100)] = -1
    best = np.argsort(-near, axis=1)[:, :5]
    got = out.groupby("query_id")["vec_id"].agg(set)
    assert np.mean([len(set(b) & got.get(100 * i, set())) / 5 for i, b in enumerate(best.tolist())]) >= 0.9


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    q = quality.op4_quality(spark, sf).toPandas()
    q = q[q["held_out"] & q["doc_id"].isin(labels.index)]
    assert (q["predicted"].to_numpy() == labels.loc[q["doc_id"], "quality"].to_numpy()).mean() > 0.95
    t = toxicity.op7_toxicity(spark, sf).toPandas()
    t = t[t["held_out"] & t["doc_id"].isin(labels.index)]
    assert (t["predicted"].to_numpy() == labels.loc[t["doc_id"], "toxic"].to_numpy()).mean() > 0.88
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    p = language.op5_language(spark, sf).toPandas().merge(lang, on="doc_id")
    p = p[p["held_out"]]
    assert (p["lang_pred"] == p["lang"]).mean() > 0.97


def test_quality_sees_all_words():
    words = [f"w{k}" for k in range(200)]
    at = quality.QUALITY.index("unique_in_window")
    assert quality.quality_features(" ".join(words))[at] == 1.0
    assert quality.quality_features(" ".join(words[:50] + ["junk"] * 150))[at] == pytest.approx(53 / 200)
    assert quality.quality_features(" ".join(words[:50] + ["junk"] * 10))[at] == pytest.approx(51 / 60)


def test_classifiers_on_odd_rows(spark):
    docs, none = docs_of(spark, ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.with_quality(docs, quality.fit(docs, none)).count() == len(ODD)
    assert toxicity.with_toxicity(docs, toxicity.fit(docs, none)).count() == len(ODD)
    got = language.with_language(docs, language.fit(docs)).collect()
    assert len(got) == len(ODD) and all(r["lang_pred"] == "und" for r in got if not (r["text"] or "").strip())


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(8)
    names = [*[f"q{k:02}" for k in range(62)], "en-AU", "en-GB", "en-US", "en"]
    rows = []
    for name in names:
        words = ["".join(chr(97 + k) for k in rng.integers(0, 26, 6)) for _ in range(30)]
        rows += [(len(rows) + k, " ".join(rng.choice(words, 60)), name, None, 0) for k in range(8)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.fit(docs)
    assert sorted(x for own in model.families.values() for x in own) == sorted(names) and len(model.pairs) == 6
    got = language.with_language(docs, model).select("lang", "lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_language_of_a_text_is_found_once(spark, capsys):
    """A second evaluation in the same task takes a second worker of each core, which stays beside the stages that follow."""
    docs = common.table(spark, SF, "documents")
    kept, found = language.known_language(docs), language.with_language(docs, language.fit(docs))
    kept.explain("simple")
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    want = found.where("lang_pred != 'und' and score >= 0.5").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*common.DOCUMENT_COLUMNS)
    assert kept.count() > 0 and sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))


def test_url_rules_and_model(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.com/en/x?y"), (4, "http://www.example.com/en/"), (5, "http://com"), (6, "http://x.net/fr/1#z"), (7, "http://x.net/frx"), (8, "http://shop.com/a")]
    out = {r["page_id"]: r for r in urls.filtered(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))).collect()}
    assert [out[i]["rule"] for i in range(1, 9)] == [None, None, "example.com/en/", "www.example.com/en/", None, "net/fr/", None, "com/"]
    assert out[3]["host"] == "a.example.com" and out[3]["path"] == "/en/x" and all(r["verdict"] in ("allow", "block") for r in out.values())
    counted = defaultdict(lambda: [0, 0])
    for url, side in (("ab", 0), ("abb", 1), ("ab", 0)):
        s = "\x02" * 4 + url + "\x03"
        for i in range(len(s) - 4):
            counted[s[i : i + 5]][side] += 1

    def p(gram, side, k):
        tail = {g: n for g, n in ((g[4 - k :], c[side]) for g, c in counted.items())} if k == 4 else None
        n = sum(c[side] for g, c in counted.items() if g[4 - k :] == gram[4 - k :])
        if k == 0:
            return (n + 1) / (sum(c[side] for c in counted.values()) + len({g[4] for g in counted}))
        del tail
        ctx = sum(c[side] for g, c in counted.items() if g[4 - k : 4] == gram[4 - k : 4])
        return (n + 2 * p(gram, side, k - 1)) / (ctx + 2)

    df = spark.createDataFrame([(g, a, b) for g, (a, b) in counted.items()], "g string, allowed long, blocked long")
    for r in urls.log_ratios(df).collect():
        assert r["ratio"] == pytest.approx(math.log(p(r["g"], 0, 4)) - math.log(p(r["g"], 1, 4)))


def test_url_scores_use_the_ratio_of_every_string(spark, monkeypatch):
    rng = np.random.default_rng(6)
    names = ["".join(chr(0x4E00 + k) for k in rng.integers(0, 20_000, 400)) for _ in range(400)]  # more distinct strings than 2^17
    rows = [(i, f"http://{('shop.com', 'x.net', 'y.org')[i % 3]}/{('a', 'fr', 'b')[i % 3]}/{n}") for i, n in enumerate(names)] + [(9000, None), (9001, None)]
    monkeypatch.setattr(common, "OFTEN", 500)  # both ways of looking up are taken
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r for r in urls.filtered(pages).collect()}
    counted = defaultdict(lambda: [0, 0])
    for i, url in rows:
        s = "\x02" * 4 + (url or "") + "\x03"
        for k in range(len(s) - 4):
            c = counted[s[k : k + 5]]
            if got[i]["rule"]:
                c[got[i]["verdict"] == "block"] += 1
    ratio = {r["g"]: r["ratio"] for r in urls.log_ratios(spark.createDataFrame([(g, a, b) for g, (a, b) in counted.items()], "g string, allowed long, blocked long")).collect()}
    assert len(got) == len(rows) and got[9000]["url_score"] == got[9001]["url_score"] and len(counted) > 1 << 17
    for i, url in rows:
        s = "\x02" * 4 + (url or "") + "\x03"
        mean = np.mean([ratio[s[k : k + 5]] for k in range(len(s) - 4)])
        assert got[i]["url_score"] is None if got[i]["rule"] else got[i]["url_score"] == pytest.approx(mean, abs=1e-8)


def test_media_round_trip(spark):
    for r in media.with_media(docs_of(spark, ODD)).collect():
        data = (r["text"] or "").encode()
        data += bytes(-len(data) % 64 or (0 if data else 64))
        assert media.samples(bytes(r["media"])) == data
        assert r["audio"]["payload_sha256"] == hashlib.sha256(data).hexdigest() and r["audio"]["tail_crc32"] == zlib.crc32(data[-64:])
        assert len(r["audio"]["times"]) == len(r["audio"]["prints"])


def test_blocks_of_frames_change_nothing(monkeypatch):
    payload = bytes(np.random.default_rng(3).integers(0, 256, 40_000, dtype=np.uint8))
    whole = media.spectral_peaks(payload)
    monkeypatch.setattr(media, "FRAMES_AT_ONCE", 7)
    assert all((a == b).all() for a, b in zip(whole, media.spectral_peaks(payload)))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() > 0


def test_run_reads_what_each_stage_wrote(spark, monkeypatch):
    import corpus_pipeline

    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.where(f"doc_id % 7 != {len(read)}")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", stage), ("b", stage), ("c", stage)])
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert got == {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 7 not in (1, 2, 3)").collect()}
    assert [any(SF in f for f in files) for files in read] == [True, False, False]
    assert all(f"/{name}-" in f for name, files in zip("ab", read[1:], strict=True) for f in files)


def test_rows_with_null_and_repeated_ids_stay(spark):
    texts = [" ".join(f"{name}{k}" for k in range(80)) for name in "abcdef"]
    rows = [(7, texts[0]), (7, texts[1]), (9, texts[0]), (12, texts[1]), (3, texts[2]), (3, texts[2]), (None, texts[3]), (None, texts[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    one = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.one_of_each(docs).collect())
    assert one == sorted([(7, texts[0]), (7, texts[1]), (3, texts[2]), (0, texts[3]), (0, texts[4])])
    mixed = sorted((r["doc_id"] or 0, r["text"]) for r in mixing.mixed_documents(docs).collect())  # one source: all once
    assert mixed == sorted((i or 0, t) for i, t in rows)
    odd = spark.createDataFrame([(1, "x", None, "en", 1), (1, "x", "en", None, 1)], DOCS)
    assert mixing.mixed_documents(odd, most=1).count() == 2


def test_toxic_evidence_of_a_text():
    raw = ["", "a", "aa", "aaa", "aaaa b", "abbbcccd   eeee!!!", "\n\n\n\n", "a", "aa"]
    drawn = toxicity.drawn_out(*common.text_bytes(pa.array(raw)))
    assert drawn.tolist() == [len(re.findall(r"([^\x00-\x20])\1{2,}", x)) for x in raw]
    raw = ["SHUT UP NOW", "", "ABC", "ABc ABCd A1B2C3", " XYZ!", "ab"]
    assert toxicity.shouted(*common.text_bytes(pa.array(raw))).tolist() == [2, 0, 1, 1, 1, 0]
    tool = toxicity.Toxic(toxicity.Lexicon(frozenset({"bad*"}), (("bad*", 2.0), ("badly", 3.0))))
    assert [tool.weight(w) for w in ("badly", "badge", "ba", "")] == [3.0, 2.0, 0.0, 0.0]
    x = dict(zip(toxicity.FEATURES, tool.matrix(pa.array(["other", "Badly badly badge here"]))[1], strict=True))
    assert x["evidence"] == pytest.approx(math.log1p(5.0)) and x["strongest"] == 3.0 and x["learned_hits"] == pytest.approx(math.log1p(3))
    x = [dict(zip(toxicity.FEATURES, r, strict=True)) for r in tool.matrix(pa.array([None, "you i d i o t", "b4d.d" + "g" * 40, "an 1d!0t " * 3, "you " + "w " * 9 + "idiot"]))]
    assert [r["spelled_out"] for r in x] == [0, 1, 0, 0, 0] and [r["hidden_hits"] > 0 for r in x] == [False, True, True, True, False]
    assert x[4]["insult_hits"] == pytest.approx(math.log1p(1)) and x[4]["hits_near_second_person"] == 0
