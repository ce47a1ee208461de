"""The operators against plain versions, on tables with NULLs, copies, long texts and clashing names."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import catalog, ctw, forest, jaccard, lm_scores, mixing, planes, repeats, rules, suffix, toxicity, urls
from tests.llm import brute


@pytest.fixture(scope="module")
def rows():
    return brute.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.DOCUMENTS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.DOCUMENTS)


@pytest.fixture(scope="module")
def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="module")
def items(spark, pairs):
    texts = dict(pairs)
    own = [(1, " ".join(texts[5].split()[10:40])), (2, "One, TWO!"), (3, None), (4, ""), (2, " ".join(texts[9].split()[:12])), (None, "same same same")]
    return spark.createDataFrame(own, "item_id long, text string")


def as_arrow(frame):
    return frame.toArrow()


def test_mixing_matches_sql(docs, none):
    got = [tuple(r) for r in mixing.report(docs).collect()]
    want = brute.duck({"documents": as_arrow(docs.select("doc_id", "text", "source"))}, mixing.ORACLE)
    assert brute.ordered(got) == brute.ordered(want)
    copies = {}
    for r in mixing.draws(docs).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counted = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {k: v for k, v in copies.items() if v}
    assert mixing.report(none).count() == 0 and mixing.mix(none).count() == 0


def test_targets_share_all_words(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 5), (None, 1), ("d", 0)]
    found = {r["source"]: r for r in mixing.targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    assert math.isclose(sum(r["target"] for r in found.values()), 1016)
    assert found["a"]["target"] == 30 and found["c"]["target"] == 15 and found[None]["target"] == 3 and found["d"]["rate"] == 0


def test_token_planes_round_trip(docs, none, pairs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(planes.default_tokenizer())
    got = brute.ordered(tuple(r) for r in planes.round_trip(docs).collect())
    ids = {}
    for doc_id, text in pairs:
        one = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        ids.setdefault(doc_id, []).append((len(one), zlib.crc32(one.tobytes())))
    assert brute.ordered((i, n, c) for i, _, n, c in got) == brute.ordered((i, n, c) for i, own in ids.items() for n, c in own)
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == sorted((r[0] for r in got), key=lambda i: (i is not None, i))
    assert [r[1] for r in by_start] == np.cumsum([0, *[r[2] for r in by_start]])[:-1].tolist()
    assert planes.round_trip(none).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 4097])
def test_planes_come_back(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32).astype("<u4").tobytes()
    assert planes.from_planes(planes.to_planes(ids, bits), n) == ids


def test_documents_over_several_blocks(spark, docs, tmp_path):
    path = str(tmp_path / "planes")
    planes.write(docs, path, block_ids=64, bits=True)
    small = [tuple(r) for r in planes.read(spark, path, block_ids=64).collect()]
    assert brute.ordered(small) == brute.ordered(tuple(r) for r in planes.round_trip(docs).collect())


def test_encoder_equals_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(planes.default_tokenizer())
    odd = [
        "", None, " ", "<|startoftext|> x<|endoftext|>.", "<|STARTOFTEXT|>", "Don't can't. we'RE! 'tis", "É\u0301a\u0300 ﬁn. Ａb,\u3000x\u00a0y",
        "“word”. İstanbul, ΣΑΣ, ß. ª, x² 12,5 a1b2, \x1cq\x1d z\x85", "日本語。 日本語, مرحبا हिन्दी. ... !! a..b ʰa",
    ]
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in odd]
    assert planes.Encoder(open(planes.default_tokenizer(), encoding="utf-8").read()).ids(odd) == want


def test_encoder_over_all_code_points():
    """Every character after and before letters, and before a final mark, as the whole-text tokenizer has it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(planes.default_tokenizer())
    encoder = planes.Encoder(open(planes.default_tokenizer(), encoding="utf-8").read())
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(points), 2048):
        some = [chr(c) for c in points[begin : begin + 2048]]
        for form in ("a{}!", "{}b.", "{}"):
            text = " ".join(form.format(c) for c in some)
            want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if encoder.ids([text]) != [want]:
                own = [form.format(c) for c in some]
                wrong = [w for w in own if encoder.ids([w]) != [np.array(tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()]]
                raise AssertionError(wrong[:10] or "only together")


def test_repeats(docs, none, pairs):
    got = [tuple(r) for r in repeats.report(docs).collect()]
    assert brute.ordered(got) == brute.ordered(brute.repeats(pairs))
    assert repeats.report(none).count() == 0
    texts = {r["doc_id"]: r["kept"] for r in repeats.remove(docs).where("doc_id = 100").collect()}
    assert texts[100] == ""


def test_jaccard_components(docs, none, pairs):
    got = [tuple(r) for r in jaccard.report(docs).collect()]
    assert brute.ordered(got) == brute.ordered(brute.components(pairs))
    assert jaccard.report(none).count() == 0


def test_jaccard_keeps_one_of_each(docs, none, pairs):
    kept = jaccard.first_of_each(docs)
    assert kept.columns == docs.columns
    found = brute.components(pairs)
    empty = sum(n == 0 for _, n, _ in found)
    assert kept.count() == len({c for _, n, c in found if n}) + empty
    assert jaccard.first_of_each(none).count() == 0


def test_jaccard_one_large_family_makes_no_pairs_of_groups(spark, monkeypatch):
    """All groups of a family fall under one leader, so none meets another one."""
    draw = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(900):
        own = list(base)
        own[draw.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows += [(5000 + i, " ".join(f"q{i}-{j}" for j in range(50))) for i in range(3)]
    visits = []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    saved = jaccard.durable

    def watched(df):
        out = saved(df)
        if out.columns == ["class", "leader", "to"]:
            visits.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "durable", watched)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.report(docs).collect()}
    assert len(visits) == 1 and visits[0] <= 2 * 900 // 64
    assert {got[i] for i in range(900)} == {0} and [got[5000 + i] for i in range(3)] == [5000, 5001, 5002]


def test_jaccard_family_of_near_copies(spark):
    """One large family over many groups and levels, and a chain whose ends do not link."""
    draw = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        own = list(base)
        own[draw.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(6):
        rows.append((1000 + i, " ".join([f"z{j}" for j in range(2 * i)] + chain[2 * i :])))
    got = [tuple(r) for r in jaccard.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()]
    assert brute.ordered(got) == brute.ordered(brute.components(rows))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found.get(i, i) for i in range(41)} == {0} and {found.get(200 + i) for i in range(30)} == {100}


def test_decontamination_matches_sql(docs, none, items):
    got = [tuple(r) for r in suffix.report(docs.where("doc_id is not null and doc_id <> 600"), items).collect()]
    tables = {"documents": as_arrow(docs.where("doc_id is not null and doc_id <> 600").select("doc_id", "text")), "benchmark": as_arrow(items)}
    assert brute.ordered(got) == brute.ordered(brute.duck(tables, suffix.ORACLE))
    assert any(r[5] for r in got)
    clean = suffix.clean(docs, items)
    assert clean.columns == docs.columns
    bad = {r[0] for r in got if r[5]}
    assert not bad & {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert suffix.report(none, items).count() == 0
    assert suffix.clean(docs, items.limit(0)).count() == docs.count()


def test_decontamination_in_blocks_and_shards(docs, items, monkeypatch):
    whole = [(r["row"]["doc_id"], r["n_words"], r["spans"], sorted(r["items"])) for r in suffix.find(docs, items, carry=["doc_id", "text"]).collect()]
    monkeypatch.setattr(suffix, "SHARD_WORDS", 100)
    split = suffix.find(docs, items, carry=["doc_id", "text"], block_chars=40)
    assert sorted(map(str, whole)) == sorted(str((r["row"]["doc_id"], r["n_words"], r["spans"], sorted(r["items"]))) for r in split.collect())


def test_decontamination_in_blocks_judges_rows_by_their_texts(spark, items, pairs, monkeypatch):
    texts = dict(pairs)
    rows = [(i, t) for i in (7, None) for t in (texts[5], texts[9], texts[30], "one two", None, texts[9])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = [tuple(r) for r in suffix.report(frame, items).collect()]
    real = suffix._blocks
    monkeypatch.setattr(suffix, "_blocks", lambda items, window, block_chars: real(items, window, 40))
    assert brute.ordered(tuple(r) for r in suffix.report(frame, items).collect()) == brute.ordered(whole)
    assert {r[5] for r in whole} == {True, False}


def test_longest_matches(docs, items):
    found = {(r["item_id"], r["item_start"]): r for r in suffix.longest_matches(docs, items).collect()}
    assert found[("1", 0)]["n_words"] == 30 and found[("1", 0)]["doc_id"] == 5 and found[("1", 0)]["doc_start"] == 10


def test_unigram_base_and_scores(docs, none, pairs):
    found = lm_scores.score(docs).collect()
    got = [(*r[:5], round(r["base_score"], 6)) for r in found]
    assert brute.ordered(got) == brute.ordered(brute.unigrams(pairs))
    assert all(r["score"] < 0 for r in found)
    assert lm_scores.score(none).count() == 0


def test_context_tree_query_counts_words_in_lower_case(spark, rows, tmp_path):
    own = [(*row[:1], row[1] and row[1].replace("a", "A").replace("é", "É") if i % 2 else row[1]) for i, row in enumerate(rows)]
    spark.createDataFrame(own, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(*r[:5], round(r["base_score"], 6)) for r in catalog.BUILDERS["op5_context_tree"](spark, str(tmp_path)).collect()]
    small = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    lowered = [(i, text and text.translate(small)) for i, text in own]
    assert brute.ordered(got) == brute.ordered(brute.unigrams(lowered)) != brute.ordered(brute.unigrams(own))


def test_context_tree_against_recursion():
    texts, depth = [b"abracadabra abra", b"banana", b""], 2
    found, _ = ctw.text_grams(texts, depth)
    keys, counts = ctw.counted(found)
    model = ctw.Model([ctw.summed(ctw.shorter(keys, depth, d), counts) for d in range(depth + 1)])
    tree = [{} for _ in range(depth + 1)]
    for text in texts:
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                own = tree[d].setdefault(tuple(data[i - j] for j in range(1, d + 1)), {})
                own[data[i]] = own.get(data[i], 0) + 1

    def below(own, bits, value):
        return sum(n for s, n in own.items() if s >> (8 - bits) == value)

    def block(own):
        total = 0.0
        for bits in range(8):
            for value in {s >> (8 - bits) for s in own}:
                a, b = below(own, bits + 1, 2 * value), below(own, bits + 1, 2 * value + 1)
                total += math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
        return total

    def weighted(context):
        own = block(tree[len(context)][context])
        if len(context) == depth:
            return own
        longer = sum(weighted(c) for c in tree[len(context) + 1] if c[:-1] == context)
        return np.logaddexp(own, longer) - math.log(2)

    def predicted(context, symbol, d=0):
        own = tree[d].get(context[:d])
        if own is None:
            return 1 / 256
        p, total = 1.0, sum(own.values())
        for bits in range(1, 9):
            part = below(own, bits, symbol >> (8 - bits))
            p, total = p * (part + 0.5) / (total + 1), part
        if d == depth:
            return p
        stop = math.exp(block(own) - math.log(2) - weighted(context[:d]))
        return stop * p + (1 - stop) * predicted(context, symbol, d + 1)

    for text in (b"abra", b"bax", b"", b"zz\x00"):
        data = b"\xff" * depth + text + b"\xff"
        want = sum(math.log10(predicted(tuple(data[i - j] for j in range(1, depth + 1)), data[i])) for i in range(depth, len(data)))
        assert math.isclose(model.log10(ctw.text_grams([text], depth)[0]).sum(), want, rel_tol=1e-9)


def test_model_stays_within_its_bound(docs, monkeypatch):
    monkeypatch.setattr(ctw, "MAX_ENTRIES", 2000)
    model = lm_scores.fit(docs)
    assert all(len(level.keys) <= 2000 for level in model.levels) and len(model.levels[-1].keys) > 0


def test_scores_use_every_gram(docs, pairs, monkeypatch):
    """Whole counts at any size: a bound on the model in memory, small slices and pieces change no score."""
    monkeypatch.setattr(ctw, "MAX_ENTRIES", 2000)
    monkeypatch.setattr(lm_scores, "SLICE_BYTES", 1 << 15)
    monkeypatch.setattr(lm_scores, "TEXT_BYTES", 1 << 13)
    texts = [(i, (t or "").encode()) for i, t in pairs]
    training = [t for i, t in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    keys, counts = ctw.counted(ctw.text_grams(training)[0])
    model = ctw.Model([ctw.summed(ctw.shorter(keys, ctw.DEPTH, d), counts) for d in range(ctw.DEPTH + 1)])
    want = lm_scores.model_scores(model, [t for _, t in texts])
    got = lm_scores.score(docs).collect()
    assert brute.ordered((r["doc_id"], round(r["score"], 5)) for r in got) == brute.ordered((i, round(float(w), 5)) for (i, _), w in zip(texts, want))


def held_out_accuracy(frame, labels, column):
    joined = frame.where("held_out").join(labels, "doc_id").where(F.col(column).isNotNull())
    return joined.agg(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]


def test_quality_rules(spark, docs, none):
    tables = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]
    found = rules.report(*tables).cache()
    assert held_out_accuracy(found, tables[1], "quality") > 0.9
    assert found.agg(F.min("score"), F.max("score")).first()[0] >= 0
    odd = spark.createDataFrame([(1, None, 1), (2, 1, None), (None, 0, 0), (3, 0, 0), (3, 1, 1), (5, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    scored = rules.report(docs, odd)
    assert scored.count() == docs.count() and scored.where("score is null or predicted is null").count() == 0
    assert rules.report(none, odd).count() == 0 and rules.report(docs, odd.limit(0)).count() == docs.count()


def test_rules_become_columns(spark):
    rule = rules.simplified((("upper", True, 0.5), ("upper", True, 0.2), ("bars", False, 0.1)))
    assert rule == (("bars", False, 0.1), ("upper", True, 0.2))
    frame = spark.createDataFrame([(0.1, 0.2), (0.3, 0.2), (0.1, 0.1)], "upper double, bars double")
    assert [r[0] for r in frame.select(rules.holds(rule)).collect()] == [True, False, False]


def test_toxicity(spark, docs, none):
    tables = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]
    found = toxicity.report(*tables)
    assert held_out_accuracy(found, tables[1], "toxic") > 0.88
    odd = spark.createDataFrame([(1, None, 1), (2, 1, None), (None, 0, 0), (3, 0, 0), (3, 1, 1), (5, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    scored = toxicity.report(docs, odd)
    assert scored.count() == docs.count() and scored.where("score is null or predicted is null").count() == 0
    kept = toxicity.accepted(docs, odd)
    assert kept.columns == docs.columns
    assert toxicity.report(none, odd).count() == 0 and toxicity.report(docs, odd.limit(0)).count() == docs.count()


def test_toxicity_derivatives():
    draw = np.random.default_rng(0)
    features = toxicity.Features([bytes(draw.integers(97, 123, int(draw.integers(2, 9))).astype(np.uint8)) for _ in range(30)])
    model, windows = toxicity.initial(), draw.integers(0, 30, (4, toxicity.WINDOW))
    windows[0, 20:] = 30
    labels = np.array([1, 0, 1, 0], dtype=np.float32)

    def loss(m):
        z = toxicity.logits(m, toxicity.project(m, features), windows).astype(np.float64)
        return np.mean(np.logaddexp(0, z) - labels * z)

    slopes = toxicity.gradients(model, features, windows, labels)
    for name, slope in slopes.items():
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert math.isclose(slope[at], (loss(up) - loss(down)) / 2e-2, rel_tol=2e-2)


def test_windows_cover_every_word():
    for n in (0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 500):
        covered = {i for s in toxicity._starts(n).tolist() for i in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n))


def test_long_runs_of_letters_are_read_to_their_end():
    model = toxicity.initial()
    first = "\u6f22" * 8  # 24 bytes
    texts = [first, first + "\u5b57" * 40, first + "\u5b57" * 39 + "\u6bd2", "a" * 24, "a" * 24 + "b", "a" * 500 + "b"]
    assert len(set(toxicity.scores(model, 0.5, texts).tolist())) == len(texts)
    for n in range(1, 120):
        word = bytes(np.random.default_rng(n).integers(97, 123, n, dtype=np.uint8))
        pieces = toxicity.words(f"x {word.decode()} y")[1:-1]
        grams = {word[i : i + size] for size in toxicity.GRAMS for i in range(n - size + 1)}
        assert grams == {p[i : i + size] for p in pieces for size in toxicity.GRAMS for i in range(len(p) - size + 1)}
        assert max(map(len, pieces)) <= toxicity.LETTERS and (n > toxicity.LETTERS or pieces == [word])


def judged(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in urls.FIXED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    shapes = ["https://casino.Example.biz/win/{}?a=1", "https://good.example.biz/play/{}", "http://casino.example.biz/play/{}#x", "http://casino.example.biz/play/{}#y"]
    rows = [(i, shapes[i % 4].format(i)) for i in range(240)]
    rows += [(1000, None), (1001, "no scheme"), (1002, "HTTP://NET?x"), (1003, "x://a.Example.NET/en/q"), (1004, "x://xnet/"), (1005, ""), (1006, "://"),
             (1007, "a://b.org/fr/?://c.net/"), (1008, "x://example.com/de/\n"), (1009, "a b://net/ c"), (1009, "a b://net/ c"), (None, "x://É.net/")]
    pages = spark.createDataFrame([(*r, "h", "x") for r in rows], "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(240)] + [(5, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = urls.report(pages, labels).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["page_id"], []).append(r)
    for page_id, url in rows:
        host, path, rule, verdict = judged(url)
        r = by_id[page_id][0]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        if verdict:
            assert r["verdict"] == verdict
        else:
            assert r["verdict"] == ("block" if "/win/" in (url or "") else "allow"), url
    assert urls.report(pages.limit(0), labels).count() == 0
    assert urls.report(pages, labels.limit(0)).where("verdict = 'block' and rule is null").count() == 0


def test_mined_rules_are_what_counting_gives(spark):
    draw = random.Random(4)
    rows = [(i, f"x://{draw.choice('ab')}.{draw.choice('cd')}/{draw.choice('ef')}/") for i in range(400)]
    bad = {i: int("a." in u and "/e/" in u or draw.random() < 0.2) for i, u in rows}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - b, 0) for i, b in bad.items()], "doc_id long, quality int, toxic int")
    tokens = {r["page_id"]: set(r["t"]) for r in pages.select("page_id", urls.tokens_of(F.col("url")).alias("t")).collect()}
    for r in urls.mine(pages, labels).collect():
        own = [i for i, t in tokens.items() if set(r["tokens"]) <= t]
        support = sum(bad[i] for i in own)
        assert r["support"] == support and math.isclose(r["confidence"], support / len(own))


def test_url_rules_of_many_hosts_and_long_urls(spark):
    """Some 10,000 combinations of 270 bad hosts leave room for five rarer ones; the commonest token of long URLs is counted whole."""
    bad = [f"x://m.z{h}.example.biz/path?key={i}" for h in range(275) for i in range(21 if h < 270 else 20)]
    bad += [f"x://long.info/{'/'.join(f'p{k}' for k in range(14))}"] * 100
    good = [f"x://m.fine{i % 7}.example.biz/path?key={i}" for i in range(7000)] + ["x://other.info/p0"] * 60
    rows = list(enumerate(bad + good)) + [(20000, "x://new/p0"), (20001, "x://m.new.example.biz/path?key=1")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= len(bad)), 0) for i in range(len(bad) + len(good))], "doc_id long, quality int, toxic int")
    rules = {tuple(r["tokens"]): (r["confidence"], r["support"]) for r in urls.mine(pages, labels).collect()}
    assert rules[("path:p0",)] == (100 / 160, 100) and rules[("path:p13",)] == (1.0, 100)
    assert {("host:z274",), ("site:m.z274.example.biz",)} <= set(rules) and ("host:biz", "host:z274") not in rules
    found = {r["page_id"]: (r["verdict"], r["confidence"]) for r in urls.report(pages, labels).collect()}
    assert all(found[i] == ("block", 1.0) for i in range(len(bad)))
    assert found[20000] == ("block", 100 / 160) and found[20001] == ("allow", None)


def test_forest_finds_neighbours(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = forest.report(table).toPandas()
    data = table.toPandas()
    vectors, ids = np.stack(data["embedding"]).astype(float), data["vec_id"].to_numpy()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        own = found[found.query_id == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, len(order) + 1))
        hits, total = hits + len(set(ids[order]) & set(own["vec_id"])), total + len(order)
        assert np.allclose(own["score"], [scores[np.flatnonzero(ids == v)[0]] for v in own["vec_id"]], rtol=1e-12)
    assert hits / total >= 0.9


def test_forest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (20, [0.0, 0.0]), (40, [nan, 1.0]), (60, [None, 1.0]), (80, [inf, 1.0]),
            (100, []), (120, [5.0, 1.0]), (120, [2.0, 1.0]), (None, [1.0, 1.0]), (140, [1.0, 2.0, 3.0]), (5, [-3.0, 4.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, score string")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in forest.report(frame).collect()}
    assert [got.get((0, i), (None,))[0] for i in range(1, 7)] == [120, 120, 1, 2, 5, None]
    assert got[(0, 1)] == (120, 5.0) and {q for q, _ in got} == {0, 120}
    assert forest.report(frame.limit(0)).count() == 0


def test_forest_repeated_query_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.standard_normal(5).tolist()) for i in range(1, 60)] + [(0, [1.0] * 5)] * 3 + [(100, [2.0, 0.0, 0.0, 0.0, 0.0]), (100, [-1.0, 0.0, 0.0, 0.0, 0.0])]
    found = forest.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    for query, vector in ((0, [1.0] * 5), (100, [-1.0, 0.0, 0.0, 0.0, 0.0])):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        near = sorted((-float(np.dot(vector, v)), i) for i, v in rows if i != query)[:20]
        assert [r[0] for r in own] == list(range(1, 21))
        assert [r[1] for r in own] == [i for _, i in near] and np.allclose([r[2] for r in own], [-s for s, _ in near])


def test_toxic_passages_anywhere_in_long_texts_are_learned(spark):
    """Whole training texts are used: a passage near the end of 20,000 words, and a bound on windows that passes rows over."""
    plain = " ".join(f"calm{'abcdefgh'[i % 8]} word" for i in range(10_000))
    rows = [(i, f"{plain} vile vicious venom {'calm word ' * 20}" if i % 2 else plain) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows}
    bags = toxicity.sample(docs, labels)
    assert sorted((len(own), label) for own, label in bags) == sorted((len(t.split()), i % 2) for i, t in rows if not held[i])
    grid = toxicity.Windows([own for own, _ in bags])
    number = {w: n for n, w in enumerate(grid.distinct)}
    for i, (own, _) in enumerate(bags):
        mine = np.flatnonzero(grid.owner == i)
        assert len(mine) == len(toxicity._starts(len(own)))
        for place in (0, len(mine) // 2, len(mine) - 1):
            begin = int(toxicity._starts(len(own))[place])
            assert grid[mine[place : place + 1]][0].tolist() == [number[w] for w in own[begin : begin + toxicity.WINDOW]]
    assert len(toxicity.sample(docs, labels, windows=900)) == 2
    twice = docs.unionByName(docs).unionByName(docs.limit(0))
    assert sorted(map(str, toxicity.sample(twice, labels))) == sorted(map(str, bags))


def plain_logit(model, own):
    """The network on one window, step by step."""
    features = toxicity.Features(own)
    x = np.array([np.concatenate([model["words"][features.word[i]], np.mean([model["grams"][g] for g, real in zip(features.grams[i], features.real[i]) if real], axis=0)])
                  for i in range(len(own))]) @ model["input"] + model["bias"]
    h, states = toxicity.HIDDEN, {}
    for side, order, part in (("ahead", range(len(own)), x[:, : 3 * h]), ("back", range(len(own) - 1, -1, -1), x[:, 3 * h :])):
        state, states[side] = np.zeros(h), {}
        for t in order:
            inner = state @ model[side]
            keep, reset = (1 / (1 + np.exp(-(part[t, k * h : (k + 1) * h] + inner[k * h : (k + 1) * h]))) for k in (0, 1))
            fresh = np.tanh(part[t, 2 * h :] + reset * inner[2 * h :])
            state = (1 - keep) * fresh + keep * state
            states[side][t] = state
    both = [np.concatenate([states["ahead"][t], states["back"][t]]) for t in range(len(own))]
    weight = np.exp([b @ model["attention"] for b in both])
    return float((weight / weight.sum()) @ [b @ model["output"] for b in both] + model["offset"][0])


def test_toxicity_scores_equal_a_plain_pass():
    draw, model = random.Random(3), toxicity.initial()
    texts = [" ".join("".join(draw.choice("abcdef") for _ in range(draw.randint(1, 9))) for _ in range(n)) for n in (1, 5, 48, 49, 130)]
    for text, score in zip(texts, toxicity.scores(model, 0.5, texts)):
        own = toxicity.words(text)
        best = max(plain_logit(model, own[s : s + toxicity.WINDOW]) for s in toxicity._starts(len(own)).tolist())
        assert math.isclose(score, 1 / (1 + math.exp(-best)), rel_tol=1e-4)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_match_their_sql(spark, sf_dir, duck, name):
    from tests.oracle import difference

    assert difference(catalog.BUILDERS[name](spark, sf_dir), catalog.ORACLES[name], duck) == ""


def test_sketch_never_misses():
    from larkspur.llm import countmin

    prints = np.random.default_rng(1).integers(0, 2**63, (5000, 2), dtype=np.int64).astype(np.uint64)
    many = np.concatenate([prints, prints[:700]])
    for record in countmin.partial(many, 20):
        assert pa.types.is_binary(pa.scalar(record["slots"]).type)
    bits = countmin.width_bits(len(many))
    bitmaps = [bytearray((1 << bits) // 8) for _ in range(countmin.ROWS)]
    for row, found in enumerate(countmin.slots(many, bits)):
        seen = np.bincount(found, minlength=1 << bits) >= 2
        bitmaps[row][:] = np.packbits(seen).tobytes()
    assert countmin.seen_twice(prints[:700], bits, bitmaps).all()
    assert countmin.seen_twice(prints[700:], bits, bitmaps).mean() < 0.3


def test_jaccard_opens_groups_only_for_sets_with_a_shingle_of_them(spark, monkeypatch):
    kept, whole = {}, jaccard.durable

    def noted(df):
        out = whole(df)
        kept.setdefault(tuple(out.columns), []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "durable", noted)
    texts = [" ".join(words) for words in itertools.permutations("abcdef", 4)]  # no two have the same shingles
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.report(docs).collect()}
    assert got == {i: i for i in range(len(texts))}
    assert kept["class", "leader", "to"][0] <= 100  # of 360 classes, one shingle in each prefix, six classes a shingle
    assert max(kept["class", "group", "leader"][1:3]) <= 100  # nor are all of them grouped again


def test_jaccard_near_copies_too_far_apart_visit_no_group(spark, monkeypatch):
    """Copies with so many shingles of their own that no two can link share prefix shingles, and still none visits."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        own = list(base)
        for k in range(5):  # 15 shingles of its own, of 198; the prefix has 20
            own[40 * k + draw.randrange(1, 38)] = f"x{i}-{k}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join([*base[:100], f"y{i}", *base[101:]])) for i in range(3)]
    visits, saved = [], jaccard.durable

    def watched(df):
        out = saved(df)
        if set(out.columns) == {"class", "leader", "to"}:
            visits.append(out.select("class").distinct().count())
        return out

    monkeypatch.setattr(jaccard, "durable", watched)
    got = [tuple(r) for r in jaccard.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert brute.ordered(got) == brute.ordered(brute.components(rows))
    assert max(visits) <= 3


def test_encoder_asks_the_tokenizer_in_few_calls():
    """Words that are no run of letters are encoded together, and known words not again."""
    encoder = planes.Encoder(open(planes.default_tokenizer(), encoding="utf-8").read())
    calls = []

    class Counted:
        def __getattr__(self, name):
            whole = getattr(encoder_tokenizer, name)
            return lambda *args, **named: (calls.append(name), whole(*args, **named))[1]

    encoder_tokenizer = getattr(encoder, "tokenizer", None) or encoder.encode.__self__
    encoder.tokenizer, encoder.encode = Counted(), Counted().encode
    text = " ".join([*(f"10.{i}.7" for i in range(300)), *(f"wörd{chr(97 + i % 26)}{chr(97 + i // 26)}," for i in range(300))])
    want = np.array(encoder_tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert encoder.ids([text, None]) == [want, b""]
    assert len(calls) <= 4
    assert encoder.ids([text.upper()]) == [want] and len(calls) <= 4


def test_encoder_hands_plain_words_to_the_model():
    """Words of a-z skip the tokenizer's regular expressions and have the ids of whole texts."""
    encoder = planes.Encoder(open(planes.default_tokenizer(), encoding="utf-8").read())
    whole, calls = encoder.tokenizer, []

    class Counted:
        def __getattr__(self, name):
            return lambda *args, **named: (calls.append(name), getattr(whole, name)(*args, **named))[1]

    encoder.tokenizer = Counted()
    texts = [" ".join(f"re{'xyz'[i % 3]}l{chr(97 + i % 26) * (i % 5)}s" for i in range(3000)), "Don't WE'RE the THE theThe s t ll", "x" * 500]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert encoder.ids(texts[:1]) == want[:1] and len(calls) <= 1  # words without marks have the empty one
    assert encoder.ids(texts) == want
