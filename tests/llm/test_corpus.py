"""Operators against brute force, on small tables with nulls, repeats, empty and very long texts."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import exact, language, minhash, mixing, packing, quality
from varloom.llm.links import connected
from varloom.llm.queries import tokenizer_path

SPACE = re.compile(r"[\x20\x09-\x0D]")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(SPACE.sub("", r["text"] or ""), []).append(r)
    best = {}
    for norm, group in groups.items():
        order = sorted(group, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        best[norm] = (order[0]["doc_id"], len(group))
    return groups, best


def test_exact_groups_are_those_of_the_normalised_texts(docs):
    groups, best = brute_exact(rows_of(docs))
    found = rows_of(exact.exact_duplicates(docs))
    assert len(found) == docs.count()
    want = sorted(
        str((r["doc_id"], *best[norm], hashlib.sha256(norm.encode()).hexdigest())) for norm, group in groups.items() for r in group
    )
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in found) == want
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_dedup_keeps_one_row_with_all_columns(docs, empty):
    left = exact.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert left.count() == len(brute_exact(rows_of(docs))[0])
    assert exact.exact_duplicates(empty).count() == 0 and exact.drop_exact_duplicates(empty).count() == 0


def test_chunks_join_to_the_text_and_follow_content(spark):
    base = "".join(chr(97 + i) for i in np.random.default_rng(0).integers(0, 26, 60_000))
    texts = spark.createDataFrame([(base,), ("x" * 300 + base,), ("",), ("a" * 9_000,)], "text string")
    cut = [r.c for r in texts.select(exact.chunks(F.col("text")).alias("c")).collect()]
    assert ["".join(c) for c in cut] == [base, "x" * 300 + base, "", "a" * 9_000]
    assert len(set(cut[0]) & set(cut[1])) > len(cut[0]) // 2
    assert max(map(len, cut[3])) <= exact.MOST


def test_chunks_under_one_digest_stay_apart(docs):
    coarse = lambda chunk: F.unhex(F.substring(F.md5(chunk), 1, 2))
    groups, best = brute_exact(rows_of(docs))
    found = rows_of(exact.exact_groups(docs, digest=coarse))
    assert {(r["text_sha256"], r["group_size"]) for r in found} == {
        (hashlib.sha256(norm.encode()).hexdigest(), size) for norm, (_, size) in best.items()
    }


def test_connected_classes_of_chains_and_stars(spark):
    ids = np.random.default_rng(0).permutation(200).tolist()
    edges = [(ids[i], ids[i + 1]) for i in range(80)] + [(ids[100], ids[i]) for i in range(101, 150)] + [(ids[160], ids[160])]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {x: root(x) for x in parent}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_near(texts):
    sets = [minhash.weights(minhash.shingle_hashes(minhash.word_hashes(t or "")), minhash.NONE) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and minhash.similarity(sets[i], sets[j]) >= 0.8:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def edited(words, at, word="other"):
    return " ".join(words[:at] + [word] + words[at + 1 :])


def test_near_classes_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    passage = [f"p{i}" for i in range(90)]
    texts = [" ".join(base)] + [edited(base, int(a), f"n{a}") for a in rng.integers(0, 120, 20)]
    texts += [" ".join(passage + [f"u{k}x{i}" for i in range(60)]) for k in range(30)]
    texts += ["short text", "short text", "Short  TEXT", None, "", " \t"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(table).collect()}
    assert [found[i] for i in range(len(texts))] == brute_near(texts)


def test_near_dedup_keeps_one_of_each_class(docs, empty):
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    texts = [r.text for r in left.collect()]
    assert sum(t is not None and t.startswith("The cat") for t in texts) == 1
    assert sum(t is not None and t.startswith("wort0") for t in texts) == 1
    assert sum(not t or not t.strip() for t in texts) == 4
    assert len(rows_of(minhash.near_duplicates(docs))) == docs.count()
    assert minhash.near_duplicates(empty).count() == 0


def test_samples_agree_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    shingles = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    weight = rng.choice([1.0, 1.0, 0.9, 1.7, 2.4], 400)
    sets = []
    for low, high in ((0, 300), (60, 400)):
        order = np.argsort(shingles[low:high])
        sets.append((shingles[low:high][order], weight[low:high][order] * (1.0 if low else 1.1)))
    drawn = minhash.samples_of(sets, 2048)
    assert abs((drawn[0] == drawn[1]).mean() - minhash.similarity(*sets)) < 0.05


def water(sizes, weights, epochs=3):
    total, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in free)
        over = [i for i in free if left * weights[i] / sum(weights[j] for j in free) > epochs * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / sum(weights[j] for j in free)
            return target
        for i in over:
            target[i] = float(epochs * sizes[i])
        free -= set(over)
        if not free:
            return target


@pytest.mark.parametrize("seed", range(6))
def test_water_filling_is_the_fixed_point_of_clamping(spark, seed):
    rng = np.random.default_rng(seed)
    sizes, weights = rng.integers(1, 1000, 9).tolist(), rng.integers(1, 6, 9).tolist()
    table = spark.createDataFrame([(f"s{i}", s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))],
                                  "source string, source_size long, weight double")
    found = {r.source: r.target for r in mixing.water_fill(table).collect()}
    assert [found[f"s{i}"] for i in range(9)] == pytest.approx(water(sizes, weights))


def test_mix_meets_targets_and_caps(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(n)), ["big", "mid", "low", None][int(rng.integers(0, 4)) if i % 3 else 0]) for i, n in enumerate(rng.integers(0, 40, 600))]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = [(r.source, r.mix) for r in mixing.mix(table).collect()]
    assert len(mixed) == 600
    for name in ("big", "mid", "low", None):
        own = [m for s, m in mixed if s == name]
        taken = sum(m["size"] * m["copies"] for m in own)
        assert abs(taken - own[0]["target"]) <= 40 and max(m["copies"] for m in own) <= 4
        assert all(m["size"] * m["copies"] <= 3 * m["size"] for m in own)
    assert sum(m["size"] * m["copies"] for _, m in mixed) == mixing.mixture(table).select(F.sum(mixing.word_count(F.col("text")))).first()[0]


def test_mixture_handles_odd_tables(docs, empty):
    assert mixing.mix(docs).count() == docs.count()
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mixture(docs).collect()))
    assert mixing.mixture(empty).count() == 0


def test_words_encode_as_the_whole_text():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    whole, words = Tokenizer.from_file(path), packing.WordTokenizer(path)
    for text in ["", "  ", "It's don't 'S 'tis", "ΣΟΦΟΣ ΑΣ", "<|endoftext|> x<|startoftext|>y", "İ 日本語", "a\x1cb a\x85b\xa0c", "foo_bar--baz!!", "é x́ ́y", "ÀÉ.,;9½"]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing_covers_every_id_once(docs, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    want = {}
    for r in rows_of(docs):
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault((r["doc_id"], len(ids), zlib.crc32(ids.tobytes())), []).append(ids)
    placed = packing.pack_documents(docs, tokenizer_path(), window=512)
    found = rows_of(placed)
    by_doc, by_sequence = {}, {}
    texts = {k[:2]: v[0] for k, v in want.items()}
    for p in found:
        ids = texts[p["doc_id"], p["doc_tokens"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(ids.tobytes()) == p["ids_crc32"]
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["length"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for (doc_id, tokens), spans in by_doc.items():
        copies = sum(len(v) for k, v in want.items() if k[:2] == (doc_id, tokens))
        covered = np.zeros(tokens, int)
        for start, length in spans:
            covered[start : start + length] += 1
        assert (covered == copies).all()
    assert sum(len(v) for v in want.values()) == docs.count()
    fills = []
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        fills.append(end)
    assert max(fills) <= 512 and sum(f < 512 for f in fills) <= 1
    whole_windows = packing.sequences(docs, placed, tokenizer_path(), window=512).collect()
    assert len(whole_windows) == len(by_sequence) and {len(r.ids) for r in whole_windows} <= {512, *(2**i for i in range(9))}
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_sum_of_squares_takes_the_best_level():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 20, 300)
    windows = packing.sum_of_squares(sizes, 20)
    assert sorted(i for held in windows for i in held) == list(range(300))
    assert all(sizes[held].sum() <= 20 for held in windows)

    def naive():
        levels, closed = [], 0
        for s in sizes.tolist():
            options = []
            for at in sorted({0, *levels}):
                if at + s <= 20:
                    after = levels.copy()
                    if at:
                        after.remove(at)
                    if at + s < 20:
                        after.append(at + s)
                    options.append((sum(after.count(v) ** 2 for v in set(after)), at, after))
            best = min(options, key=lambda o: (o[0], o[1]))
            closed += len(best[2]) < len(levels) or (best[1] == 0 and s == 20)
            levels = best[2]
        return closed + len(levels)

    assert abs(len(windows) - naive()) <= 3


def test_language_held_out_accuracy_and_rejects(spark, docs, empty):
    english, german = "the of and to in is that it was for".split(), "der die und in den von zu das mit sich".split()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(english if i % 2 else german, 12)), "en" if i % 2 else "de") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(table.filter("doc_id < 200"))
    told = table.filter("doc_id >= 200").select("lang", language.identify(model, F.col("text")).alias("p")).collect()
    assert np.mean([r.lang == r.p.lang_pred for r in told]) > 0.98
    assert all(0 <= r.p.score <= 1 for r in told)
    odd = {r.doc_id: r.p.lang_pred for r in docs.select("doc_id", language.identify(model, F.col("text")).alias("p")).collect()}
    assert odd[3] == odd[4] == odd[5] == odd[6] == "und" and odd[7] != "und"
    left = language.keep_identified(docs, model)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} <= {1, 2, 7, 8, 9, None}
    nothing = language.train(empty)
    assert {r.p.lang_pred for r in docs.select(language.identify(nothing, F.col("text")).alias("p")).collect()} == {"und"}
    assert language.keep_identified(empty, model).count() == 0


def test_gram_counts_do_not_depend_on_the_batch(monkeypatch):
    texts = ["Das ist ein Text.", "", "é" * 5000, "x y z " * 700]
    whole = language.gram_counts(texts)
    monkeypatch.setattr(language, "CHUNK_BYTES", 64)
    assert (language.gram_counts(texts) == whole).all()
    assert all((language.gram_counts([t])[0] == row).all() for t, row in zip(texts, whole, strict=True))


def test_codewords_differ_in_many_bits():
    for classes in (2, 4, 7, 12, 30):
        code = language.codewords(classes)
        same = code @ code.T
        np.fill_diagonal(same, -1e9)
        assert (code.shape[1] - same.max()) / 2 >= max(1, code.shape[1] // 5)


def test_quality_held_out_accuracy(spark, docs, empty):
    rng = np.random.default_rng(4)
    good, bad = "steady measured careful prose about rivers and fields".split(), "CLICK!! $$$ WIN!! buy### now!!".split()
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, 20)), i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train(table.select("doc_id", "text"), table.filter("doc_id < 250").select("doc_id", "quality"))
    told = table.filter("doc_id >= 250").select("quality", quality.score(model, F.col("text")).alias("p")).collect()
    assert np.mean([(r.p >= 0.5) == (r.quality == 1) for r in told]) > 0.98
    scores = [r.p for r in docs.select(quality.score(model, F.col("text")).alias("p")).collect()]
    assert len(scores) == docs.count() and all(0 <= p <= 1 for p in scores)
    constant = quality.train(empty, empty.select("doc_id", F.col("nth").alias("quality")))
    assert constant.score("anything") == 0.5
