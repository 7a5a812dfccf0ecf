"""Small fixtures against brute force: each operator, with nulls, empties, ties, repeats and clashing columns."""
from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

import corpus_pipeline
from ordersight.llm import chat, decontam, graph, langid, lm_score, near_text, pack, quality, queries, sharding, toxicity, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row string, shard string, key string"
RNG = np.random.default_rng(5)
VOCAB = ["".join(RNG.choice(list("abcdefghilmnorstu"), RNG.integers(2, 8))) for _ in range(400)]


def prose(seed: int, n: int, vocab=VOCAB) -> str:
    return " ".join(np.random.default_rng(seed).choice(vocab, n))


def docs_of(spark, texts, langs=None):
    return spark.createDataFrame([(i if i != 3 else None, t, langs[i] if langs else None, None, None, "x", "y", "z", "k") for i, t in enumerate(texts)], DOCS)


ODD = ["", None, " \n ", "!!! ??", "a", "7 7 7", "日本語 テキスト", "word " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD + ODD[:2])


def test_hilbert_visits_neighbours():
    grid = np.array(list(itertools.product(range(8), repeat=3)))
    key = pack.hilbert(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def check_packing(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    rows = pack.pack(docs_of(spark, texts), queries.tokenizer_path()).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        got = sorted(by_doc[i if i != 3 else None], key=lambda r: r.start)
        assert [r.start for r in got] == list(np.cumsum([0] + [r.length for r in got[:-1]])) and sum(r.length for r in got) == len(ids)
        for r in got:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
    sizes = []
    for s in sorted(by_seq):
        got = sorted(by_seq[s], key=lambda r: r.offset)
        assert [r.offset for r in got] == list(np.cumsum([0] + [r.length for r in got[:-1]]))
        sizes.append(sum(r.length for r in got))
    assert sorted(by_seq) == list(range(len(by_seq)))
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes) and all(n == 1024 for n in sizes[:-10])


def test_packing_round_trip(spark):
    spaces = ["a  b", " lead", "trail ", "a\n  b \t c", "a\n b", "it's  we'll", "x  y", "<|endoftext|> a", "a   b\n\n  c"]
    check_packing(spark, ODD + spaces + [prose(i, 300) for i in range(12)])


def test_packing_empty(spark):
    assert pack.pack(docs_of(spark, []), queries.tokenizer_path()).count() == 0


def slow_losses(texts, chosen):
    """Loss of every text under a trigram model of the chosen ones, by dictionaries; counts scaled to ``chosen``'s share."""
    rows = [["", "", *lm_score.tokens(t or ""), ""] for t in texts]

    def model(which, scale):
        one, two, three, one_h, two_h = ({} for _ in range(5))
        for i in which:
            for u, v, w in zip(rows[i], rows[i][1:], rows[i][2:], strict=False):
                for table, key in ((one, w), (two, (v, w)), (three, (u, v, w)), (one_h, v), (two_h, (u, v))):
                    table[key] = table.get(key, 0) + scale
        n, words = sum(one.values()), len({w for r in rows for w in r[2:]})
        out = []
        for r in rows:
            loss = []
            for u, v, w in zip(r, r[1:], r[2:], strict=False):
                p = (one.get(w, 0) + 0.5) / (n + 0.5 * words)
                p = (two.get((v, w), 0) + 5 * p) / (one_h.get(v, 0) + 5)
                loss.append(-np.log((three.get((u, v, w), 0) + 5 * p) / (two_h.get((u, v), 0) + 5)))
            out.append((len(loss), float(np.mean(loss))))
        return out

    size = lambda which: sum(len(rows[i]) - 2 for i in which)
    every = range(len(texts))
    return model(chosen, 1), model(every, size(chosen) / size(every))


SCRIPTS = ["Привет мир, привет дом", "Мороз и солнце; день чудесный", "你好世界你好", "天地玄黄宇宙洪荒", "καλημέρα κόσμε καλημέρα", "ÀÉ the ÀÉ THE"]


@pytest.mark.parametrize(("chunk", "radix"), [(lm_score.CHUNK, lm_score.RADIX), (60, 4000)])  # one chunk and radix, several
def test_cross_entropy_against_loops(spark, monkeypatch, chunk, radix):
    monkeypatch.setattr(lm_score, "CHUNK", chunk)
    monkeypatch.setattr(lm_score, "RADIX", radix)
    texts = ODD + SCRIPTS + [prose(i, 40) for i in range(6)] + [SCRIPTS[2]]
    chosen = [8, 10, 12, 15, 16]
    target = spark.createDataFrame([(i,) for i in [*chosen, 15, 10_000, None]], "doc_id long")
    docs = docs_of(spark, texts)
    got = lm_score.cross_entropy_difference(docs, target).collect()
    want = list(zip(*slow_losses(texts, chosen), strict=True))
    assert len(got) == len(texts)
    for r in got:
        (n, target_loss), (_, corpus_loss) = want[3 if r.doc_id is None else r.doc_id]
        assert (r.tokens, r.target_loss, r.background_loss, r.score) == (n, *(pytest.approx(x, abs=1e-9) for x in (target_loss, corpus_loss, corpus_loss - target_loss)))
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[10] > by_id[11] and by_id[8] > by_id[9]  # texts of one script and shape, told apart by content
    same = lm_score.cross_entropy_difference(docs, target.limit(0)).collect()
    assert len(same) == len(texts) and all(r.score == 0 for r in same)
    assert lm_score.cross_entropy_difference(docs.limit(0), target).count() == 0


def test_cross_entropy_shuffles_counts_alone(spark, monkeypatch, capsys):
    """Chunks of texts lie in buckets and are read there; 3-grams that lie in one chunk are not sent, shared ones are."""
    monkeypatch.setattr(lm_score, "CHUNK", 400)
    monkeypatch.setattr(lm_score, "RADIX", 3000)
    texts = [prose(i, 30, VOCAB[:4] if i % 2 else VOCAB[4 + 30 * i:34 + 30 * i]) for i in range(12)]
    chosen = [1, 2, 5, 8]
    docs = docs_of(spark, texts)
    sent, counted = {}, lm_score._counted

    def watched(chunks, notes, step, radixes):
        out = counted(chunks, notes, step, radixes)
        sent[step] = sum(len(lm_score.restored(r.corpus, np.uint32)) for r in out.select("corpus").collect())
        return out

    monkeypatch.setattr(lm_score, "_counted", watched)
    result = lm_score.cross_entropy_difference(docs, spark.createDataFrame([(i,) for i in chosen], "doc_id long"))
    result.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(chunk") == 1  # the totals; the texts stay where they are
    want = list(zip(*slow_losses(texts, chosen), strict=True))
    got = result.collect()
    assert len(got) == len(texts)
    for r in got:
        (n, target_loss), (_, corpus_loss) = want[3 if r.doc_id is None else r.doc_id]
        assert (r.tokens, r.target_loss, r.background_loss) == (n, pytest.approx(target_loss, abs=1e-9), pytest.approx(corpus_loss, abs=1e-9))
    one_place = sum(len(set(zip(w, w[1:], w[2:], strict=False))) for w in (["", "", *lm_score.tokens(t), ""] for t in texts[::2]))
    every = sum(len(set(zip(w, w[1:], w[2:], strict=False))) for w in (["", "", *lm_score.tokens(t), ""] for t in texts))
    assert sent[1] and 0 < sent[2] <= every - 0.8 * one_place


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [b + rng.normal(size=16) * s for b in base for s in (0.0, 0.05, 0.15, 0.25)]
    rows = [list(map(float, r)) for r in rows] + [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, list(map(float, base[0])), list(map(float, base[0])), [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(i, r, 0, "x") for i, r in enumerate(rows)], "vec_id long, embedding array<double>, label int, node string")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    good = [i for i, r in enumerate(rows) if r and all(v is not None and np.isfinite(v) for v in r) and any(r)]
    unit = {i: np.array(rows[i]) / np.linalg.norm(rows[i]) for i in good}
    links = {i: {j for j in good if j != i and len(rows[i]) == len(rows[j]) and unit[i] @ unit[j] >= 0.9} for i in good}
    for i in range(len(rows)):
        assert got[i].n_links == len(links.get(i, ()))
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert got[i].component_id == min(seen) and got[i].kept == (min(seen) == i)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vector_audit_sees_nodes_with_one_link_and_what_is_lost_is_searched(spark, monkeypatch):
    rng = np.random.default_rng(7)
    hub = rng.normal(size=32)
    rows = [hub + rng.normal(size=32) * 0.02 for _ in range(60)]
    for _ in range(60):
        v = rng.normal(size=32)
        rows += [v, v + rng.normal(size=32) * 0.05]
    unit = np.array([r / np.linalg.norm(r) for r in rows])
    true = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if unit[i] @ unit[j] >= 0.9]
    nodes = spark.createDataFrame([(i, u.tobytes()) for i, u in enumerate(unit)], "node long, vec binary")
    table = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    assert vectors._audit(nodes, table(true), 32, 0.9) == 1.0
    lost = [(i, j) for i, j in true if i < 60 or i % 4]  # half of the pairs that are alone
    assert len(lost) / len(true) > 0.97 and vectors._audit(nodes, table(lost), 32, 0.9) < 0.7
    monkeypatch.setattr(vectors, "_pairs", lambda *_: table([]))
    monkeypatch.setattr(vectors, "BLOCK", 50)
    got = vectors.near_vectors(spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")).collect()
    assert all(r.n_links == sum(r.vec_id in p for p in true) for r in got)


def test_links_end_at_the_threshold(spark, monkeypatch):
    cosines = [0.9 + 5e-10, 0.9 - 5e-10, 0.9 + 1e-12, 0.9 - 1e-12, 0.95, 0.85]
    rows = []
    for i, c in enumerate(cosines):  # pairs in planes of their own
        u, v = np.zeros(2 * len(cosines)), np.zeros(2 * len(cosines))
        u[2 * i], v[2 * i:2 * i + 2] = 3.0, (c, np.sqrt(1 - c * c))
        rows += [u.tolist(), v.tolist()]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    want = [int(c > 0.9) for c in cosines for _ in range(2)]
    assert [r.n_links for r in vectors.near_vectors(df).orderBy("vec_id").collect()] == want
    empty = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(vectors, "_pairs", lambda *_: empty)  # all of them exactly
    assert [r.n_links for r in vectors.near_vectors(df).orderBy("vec_id").collect()] == want


INSULTS = ["idiot", "moron", "pathetic", "worthless"]


def toxic_docs(spark):
    texts = list(ODD)
    for i in range(len(ODD), 600):
        words = prose(i, 40).split()
        if i % 3 == 0:
            words[5], words[20] = INSULTS[i % 4], INSULTS[(i // 4) % 4]
        texts.append(" ".join(words))
    return texts, docs_of(spark, texts), spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(len(ODD), 600)], "doc_id long, quality int, toxic int")


def test_deobfuscation_and_toxicity(spark):
    texts, docs, labels = toxic_docs(spark)
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id >= len(ODD)]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) > 0.97
    model = toxicity.fit(docs, labels)
    r = toxicity.Restorer(model.chars)
    for bad, word in (("1d10t", "idiot"), ("p4th3t1c", "pathetic"), ("m.o.r.o.n", "moron"), ("w o r t h l e s s", "worthless"), ("idiooooot", "idiot")):
        assert r.restore(bad) == word
        assert model.scorer()([prose(1, 20) + f" {bad} " + prose(2, 20)])[0] > 0.5
    assert r.restore("call 555-2186 now") == "call 555-2186 now"
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() < len(texts)
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert toxicity.classify(docs, labels.limit(0)).filter("score <> 0.5").count() == 0


def test_long_tokens_and_words_of_signs_are_restored(spark):
    texts, docs, _ = toxic_docs(spark)
    more = docs_of(spark, texts + ["you are an ass and more", "stupid asshole"] * 40)
    r = toxicity.Restorer(toxicity.CharModel(toxicity.char_counts(more)))
    chain = ".".join(["you.are.a.p4th3t1c.w0rthl3ss.m0r0n.and.more"] * 3)
    assert len(chain) > 100 and {"pathetic", "worthless", "moron"} <= r.words(chain)
    assert "stupid" in r.words("stu" + 40 * "u" + "pid") and "stupid" in r.words("$tu" + 400 * "u" + "p1d")
    assert "ass" in r.words("so 4$$ it is") and "ass" in r.words("@$$!")
    assert "asshole" in r.words("an @ $ $ h o l e here") and r.restore("@ $ $ h o l e") == "asshole"
    assert "moron" in r.words(" ".join("moron" * 40))
    for plain in ("555-2186", "$4.50", "4,000", "2024-10-05", "+1(555)555-2186", "100km", "455", "***", "###", "---", "$$$", "10%"):
        assert not r.words(plain) - {"km"} and r.restore(plain) == plain


def test_viterbi_is_the_best_path():
    counts = np.random.default_rng(0).integers(0, 50, toxicity.SYMBOLS ** 3).astype(float)
    m = toxicity.CharModel(counts)
    lattice = toxicity.lattice_of("s1uuu0")

    def value(path):
        x = y = 0
        total = 0.0
        for piece, cost in [*path, (" ", 0.0)]:
            total -= cost
            for ch in piece:
                z = 0 if ch == " " else toxicity._CODE.get(ch, 1)
                if z or y:
                    total += float(m.logp[x, y, z])
                    x, y = y, z
        return total
    best = max(itertools.product(*lattice), key=value)
    assert m.decode(lattice) == "".join(p for p, _ in best).strip()


def test_masks_hit_every_window_with_two_substitutions():
    for gone in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(not {p + o for o in m} & set(gone) for m in decontam.MASKS for p in range(decontam.WINDOW - m[-1]))


def test_short_items_are_found_under_all_placements_of_substitutions():
    for size in range(decontam.MIN_TOKENS, decontam.WINDOW + 1):
        words = [f"w{i}" for i in range(size)]
        index = decontam.SeedIndex([0], [" ".join(words)], decontam.WINDOW, decontam.SIMILARITY)
        for gone in itertools.combinations(range(size), size - -(-4 * size // 5)):
            doc = ["a", "b", *("x" if i in gone else w for i, w in enumerate(words)), "c"]
            assert len(index.overlaps([decontam.tokens(" ".join(doc))])[0]), (size, gone)


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(9)
    items = [prose(1000 + i, int(rng.integers(6, 40))) for i in range(12)] + [None, "", "two words"]
    texts = list(ODD)
    for i in range(60):
        words = prose(i, 60).split()
        part = (items[i % 12]).split()[: int(rng.integers(5, 30))]
        part = [VOCAB[int(rng.integers(400))] if rng.random() < 0.12 else w for w in part]
        words[10:10] = part
        texts.append(" ".join(words) if i % 4 else prose(5000 + i, 60))
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    docs = docs_of(spark, texts)
    got = {r.doc_id: set(r["items"]) for r in decontam.contaminated(docs, bench).collect()}

    def overlap(doc, item):
        size = min(13, len(item))
        need = -(-4 * size // 5)
        if len(item) < decontam.MIN_TOKENS:
            return False
        for shift in range(-len(item) + 1, len(doc)):
            same = [0 <= shift + j < len(doc) and doc[shift + j] == item[j] for j in range(len(item))]
            if any(sum(same[k:k + size]) >= need for k in range(len(item) - size + 1)):
                return True
        return False
    for i, t in enumerate(texts):
        want = {k for k, x in enumerate(items) if overlap(decontam.tokens(t).tolist(), decontam.tokens(x).tolist())}
        assert got[i if i != 3 else None] == want, i
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not x for x in got.values())
    assert decontam.overlaps(docs, bench).select("doc_id", "item_id").distinct().count() == sum(map(len, got.values()))
    assert decontam.contaminated(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_quality_held_out(spark):
    texts = list(ODD) + [prose(i, 40) if i % 2 else " ".join(w + "!!" for w in prose(i, 40).upper().split()) for i in range(len(ODD), 300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(ODD), 300)], "doc_id long, quality int")
    got = quality.classify(docs_of(spark, texts), labels).collect()
    assert len(got) == 300
    assert all(r.predicted == r.doc_id % 2 for r in got if r.held_out and r.doc_id >= len(ODD))
    f, x = quality.features("a b a b a b")
    assert abs(float(x @ x) - 1) < 1e-9 and len(quality.features("")[0]) == 0


def test_forward_backward_against_enumeration():
    field = langid.Field(["a", "b", "c"], {}, moves=np.random.default_rng(1).normal(size=(3, 3)), first=np.array([0.3, -1, 0.2]))
    lengths = np.array([1, 4, 3])
    e = np.random.default_rng(2).normal(size=(8, 3))
    got, _ = field.marginals(e, lengths)
    at = 0
    for n in lengths:
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            s = field.first[path[0]] + sum(e[at + t, y] for t, y in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:], strict=False))
            for t, y in enumerate(path):
                want[t, y] += np.exp(s)
        assert np.allclose(got[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_language(spark):
    ways = {"xx": [w + "ung" for w in VOCAB], "yy": ["la" + w for w in VOCAB]}
    langs = [None] * len(ODD) + [("xx", "yy")[i % 2] for i in range(300)]
    texts = list(ODD) + [prose(i, 30, ways[g]) for i, g in enumerate(langs[len(ODD):])]
    docs = docs_of(spark, texts, langs)
    field = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, field).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2, 5))
    assert all(got[i].lang_pred == g and 0 < got[i].score <= 1 for i, g in enumerate(langs) if g)
    post, _ = field.marginals(field.emissions((prose(1, 15, ways["xx"]) + " " + prose(2, 15, ways["yy"])).split()), np.array([30]))
    assert (post.argmax(axis=1) == np.repeat([0, 1], 15)).mean() > 0.9  # code-switched
    kept = langid.drop_unidentified(docs, field, least=0.3)
    assert kept.columns == docs.columns and kept.count() <= len(texts) - 4
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(docs.limit(0))).collect()} == {"und"}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_against_dynamic_programming():
    rng = np.random.default_rng(3)
    for _ in range(400):
        a = rng.integers(0, 20, rng.integers(0, 40)).tolist()
        b = list(a)
        for _ in range(rng.integers(0, 10)):
            k = int(rng.integers(0, len(b) + 1))
            b[k:k + int(rng.integers(0, 2))] = [int(rng.integers(0, 20))] * int(rng.integers(0, 2))
        limit = int(rng.integers(0, 15))
        assert near_text.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), limit) == min(levenshtein(a, b), limit + 1)


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    texts = list(ODD) + ["", "A, a!"]
    for i in range(30):
        words = prose(i, 60).split()
        for _ in range(int(rng.integers(1, 4))):
            copy = [VOCAB[int(rng.integers(400))] if rng.random() < 0.04 else w for w in words]
            texts.append(" ".join(copy))
    words = prose(999, 80).split()  # a bucket over SMALL
    texts += [" ".join([*words[:j], "odd", *words[j:]]) for j in range(2 * near_text.SMALL)]
    docs = docs_of(spark, texts)
    got = near_text.near_duplicates(docs).collect()
    toks = [near_text.tokens(t or "").tolist() for t in texts]
    group = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if toks[i] and toks[j] and levenshtein(toks[i], toks[j]) <= 0.2 * max(len(toks[i]), len(toks[j])) + 1e-9:
            a, b = sorted((group[i], group[j]))
            group = [a if g == b else g for g in group]
    assert len(got) == len(texts) and sum(r.kept for r in got) == len({r.group_id for r in got})
    name = {r.doc_id: r.group_id for r in got if r.doc_id is not None}
    shingles = [{tuple(t[k:k + 5]) for k in range(max(1, len(t) - 4))} for t in toks]
    similar = linked = 0
    for i, j in itertools.combinations(name, 2):
        if toks[i] and toks[j]:
            if name[i] == name[j]:
                assert group[i] == group[j], (i, j)  # nothing is linked that is not similar
            if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
                assert name[i] == name[j], (i, j)  # the documented threshold is whole
            similar += group[i] == group[j]
            linked += name[i] == name[j]
    assert linked >= 0.95 * similar  # of the links that only edit similarity shows, sketches may miss a few
    kept = near_text.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert near_text.near_duplicates(docs.limit(0)).count() == 0


def test_pairs_of_large_buckets_are_whole(spark):
    rng = np.random.default_rng(6)
    texts = []
    for family in range(2):  # copies that differ from each other, many of them by more than the threshold
        words = prose(700 + family, 60).split()
        texts += [" ".join(VOCAB[int(rng.integers(400))] if rng.random() < share else w for w in words) for share in rng.uniform(0.02, 0.2, 150)]
    got = near_text.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    name = {r.doc_id: r.group_id for r in got}
    toks = [near_text.tokens(t) for t in texts]
    sketches = [near_text.sketch(t) for t in toks]
    sharing = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (sketches[i] == sketches[j]).any() and near_text.similar(toks[i], toks[j])]
    missed = [(i, j) for i, j in sharing if name[i] != name[j]]
    assert len(sharing) > 1000 and not missed, (len(sharing), len(missed), len(set(name.values())))


def test_similar_texts_share_a_value_in_every_band_of_edit_similarity():
    rng = np.random.default_rng(11)
    for size in (60, 200, 800):
        for low in (0.80, 0.85, 0.90, 0.95):
            hit = n = 0
            while n < 150:
                a = rng.integers(0, 1 << 40, size).astype(np.uint64)
                b = a.copy()
                at = rng.permutation(size)[:int(rng.integers(int((0.95 - low) * size), int((1 - low) * size) + 1))]
                b[at] = rng.integers(1 << 41, 1 << 42, len(at))
                if low <= 1 - len(at) / size < low + 0.05:
                    n += 1
                    hit += bool((near_text.sketch(a) == near_text.sketch(b)).any())
            assert hit >= 0.9 * n, (size, low, hit, n)


def test_word_counts_bound_the_distance():
    rng = np.random.default_rng(8)
    for _ in range(100):
        a, b = (rng.integers(0, 2000, rng.integers(1, 60)).astype(np.uint64) for _ in range(2))  # words of one bin are met
        x, y = near_text.word_counts(a).astype(int), near_text.word_counts(b).astype(int)
        assert max((x - y).clip(0).sum(), (y - x).clip(0).sum()) <= levenshtein(a.tolist(), b.tolist())


def test_chat_views(spark):
    rows = [(1, 0, "ann", "hi <|im_end|>"), (1, 1, "bob", None), (1, 2, "system", "s"), (1, 3, "cy", ""), (1, 4, "ann", "bye"),
            (1, 4, "ann", "bye"), (None, None, None, "x"), (2, 0, "system", "alone"), (None, 1, " ", "y")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, at int")
    got = chat.perspectives(df).collect()
    views = {}
    for r in got:
        views.setdefault((r.conv_id, r.participant), []).append(r)
    assert set(views) == {(1, "ann"), (1, "bob"), (1, "cy"), (None, "unknown")}
    for (_, who), part in views.items():
        part.sort(key=lambda r: r.position)
        whole = "".join(r.rendered for r in part)
        assert [r.position for r in part] == list(range(1, len(part) + 1))
        assert whole.count("<|im_start|>") == whole.count("<|im_end|>") == len(part)
        for r in part:
            assert whole[r.start:r.start + r.length] == r.rendered
            assert (r.role_out == "assistant") == (r.speaker == who)
            trained = whole[r.mask_start:r.mask_start + r.mask_length]
            assert trained == (r.rendered.split("\n", 1)[1][:-1] if r.role_out == "assistant" else "")
    assert chat.perspectives(df.limit(0)).count() == 0


def test_sharding_moves_only_into_the_new_shard(spark):
    tree = sharding.HashTree(3, 2, (1.0, 2.0, 1.0, 1.0, 3.0))
    df = spark.range(20000)
    for n in range(1, 15):
        df = sharding.with_shard(df, "id", n, f"n{n}", tree)
    pdf = df.toPandas()
    for n in range(2, 15):
        old, new = pdf[f"n{n - 1}"], pdf[f"n{n}"]
        assert ((old == new) | (new == n - 1)).all()
    share = pdf.n14.value_counts(normalize=True)
    for i in range(14):
        assert abs(share[i] - tree.weight(i) / sum(map(tree.weight, range(14)))) < 0.015


def test_sharding_rows(spark):
    texts = ODD + [prose(i, 20) for i in range(100)]
    got = sharding.place(docs_of(spark, texts), 40).collect()
    assert len(got) == len(texts)
    for i in range(40):
        slots = sorted(r.slot for r in got if r.shard == i)
        assert slots == list(range(len(slots)))
    for r in got:
        if r.doc_id is not None:
            raw = (texts[r.doc_id] or "").encode()
            assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.grown_shard in (r.shard, 40)
    assert sharding.place(docs_of(spark, []), 40).count() == 0


def test_stages_keep_columns_and_take_odd_rows(spark, odd, tmp_path):
    texts, docs, labels = toxic_docs(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, prose(9, 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert len(corpus_pipeline.STAGES) == 5
    for name, step in corpus_pipeline.STAGES:
        for table in (odd, odd.limit(0)):
            out = step(spark, table, str(tmp_path))
            out.count()
            if name != "packing":
                assert out.columns == docs.columns


def test_registered_queries_and_their_sql():
    import __spark_entry__ as entry
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 11)) and entry.queries()["pipeline"] is corpus_pipeline.run
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rows_of_buckets_carry_no_sketch_and_only_shared_buckets_are_kept(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{int(k)}" for k in rng.integers(0, 4000, 60)]
    rows = []
    for i in range(30):  # one family in a large bucket, its members told apart by the last words
        rows.append((i, " ".join(base[:58] + [f"x{i}", f"y{i}"])))
    rows += [(100 + i, " ".join(f"v{int(k)}" for k in rng.integers(0, 4000, 40))) for i in range(20)]
    written = {}

    def record(df, name, put=near_text.stage):
        out = put(df, name)
        written.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(near_text, "stage", record)
    got = {r["doc_id"]: r["group_id"] for r in near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 30 else i for i, _ in rows}
    per_function = [df for name in ("buckets", "shared", "finer", "mixed") for df in written[name]]
    assert not any("sketch" in df.columns for df in per_function)
    assert written["shared"][0].filter("n < 2").isEmpty() and written["buckets"][0].count() == near_text.SKETCHES * len(rows)


def test_later_rounds_are_given_the_texts_of_large_buckets_alone(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = [f"w{int(k)}" for k in rng.integers(0, 4000, 60)]
    rows = [(i, " ".join([*base[:58], f"x{i}", f"y{i}"])) for i in range(30)]
    rows += [(100 + i, " ".join(f"v{int(k)}" for k in rng.integers(0, 9000, 40))) for i in range(20)]
    pair = [f"u{int(k)}" for k in rng.integers(0, 9000, 40)]
    rows += [(200, " ".join(pair)), (201, " ".join([*pair, "more"]))]
    written, given = {}, []

    def record(df, name, put=near_text.stage):
        out = put(df, name)
        written.setdefault(name, []).append(out)
        return out

    def verify(pairs, docs, least, run=near_text._verified):
        given.append(docs.count())
        return run(pairs, docs, least)

    monkeypatch.setattr(near_text, "stage", record)
    monkeypatch.setattr(near_text, "_verified", verify)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["group_id"] for r in near_text.near_duplicates(docs).collect()}
    assert got == {i: 0 if i < 30 else 200 if i == 201 else i for i, _ in rows}
    assert [df.count() for df in written["asked"]] == [32, 30, 30] and given[0] == 32 and set(given[1:]) <= {30}
    kept = near_text.drop_near_duplicates(docs)
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"] for r in kept.collect()} == set(got.values())


def test_a_link_is_joined_again_only_while_its_ends_differ(spark, monkeypatch):
    written = []

    def record(df, name, put=graph.stage):
        out = put(df, name)
        if name == "links":
            written.append(out.count())
        return out

    monkeypatch.setattr(graph, "stage", record)

    def found(links, kind="long"):
        written.clear()
        return {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, f"a {kind}, b {kind}")).collect()}

    assert found([(99, i) for i in range(50)] + [(3, 99), (7, 7), (None, 5)]) == dict.fromkeys([*range(50), 99], 0) and written == [50, 49, 0]
    assert found([(i, i + 1) for i in range(40)]) == dict.fromkeys(range(41), 0)
    assert found([]) == {}
    rng = np.random.default_rng(2)
    links = [(f"n{a:03}", f"n{b:03}") for a, b in rng.integers(0, 300, (220, 2)).tolist()]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    assert found(links, "string") == {x: find(x) for x in list(top)}
