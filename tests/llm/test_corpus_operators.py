"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from waymark.llm import (decontamination, language_id, line_dedup, minhash_forest, mixing, personal_data, quality_classifier, quality_rules,
                         repeated_passages, token_files)
from waymark.session import scratch_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row int, label int, key string"
SPACE = "[\x20\x09-\x0d]+"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, changes):
    words, r = text.split(), random.Random(seed)
    for _ in range(changes):
        words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
    return " ".join(words)


def frame(spark, texts, sources=None, ids=None):
    ids = ids or list(range(len(texts)))
    rows = [(i, t, None, s, None, "clash", 7, 1, None) for i, t, s in zip(ids, texts, sources or ["a"] * len(texts), strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " \t\n ", "\n\n", "word", "Ünï cödé ñ", "a b c", prose(1, 40_000), prose(2, 200), prose(2, 200), "z" * 50_000]


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def test_quality_rules(spark):
    bad, good = "buy " * 200, prose(3, 120, 5000)
    texts = ODD + [bad] * 60 + [good] * 60 + [good, good]
    sources = [None] * len(ODD) + ["spam"] * 60 + ["fine"] * 60 + ["spam", None]
    out = quality_rules.rate_documents(frame(spark, texts, sources)).orderBy("doc_id").collect()
    for r, text, source in zip(out, texts, sources, strict=True):
        w = words(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        repeated = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
        kept_lines = [x for x in (text or "").split("\n") if words(x)]
        assert (r.n_words, r.n_repeat_words, r.word_chars) == (len(w), len(repeated), sum(map(len, w)))
        assert r.n_dup_lines == len(kept_lines) - len(set(kept_lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        if source == "spam":
            assert not r.kept  # the good page of a host that is nearly all junk goes with it
        if source == "fine":
            assert r.kept
    kept = quality_rules.filter_documents(frame(spark, texts, sources))
    assert kept.columns == frame(spark, texts).columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.kept}
    assert quality_rules.rate_documents(frame(spark, []).limit(0)).count() == 0


def similar(a, b, k):
    def shingles(t):
        w = words((t or "").lower())
        return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()
    x, y = shingles(a), shingles(b)
    return bool(x | y) and 100 * len(x & y) >= 80 * len(x | y)


def test_minhash_forest(spark):
    base, other, loose = prose(10, 150), prose(11, 300), prose(12, 60)
    texts = list(ODD) + [base.upper(), base] * 5 + [edited(other, k, 4) for k in range(60)] + [edited(loose, k, 3) for k in range(40)]
    chain = prose(13, 100).split()
    texts += [" ".join(chain[:100 - 6 * k] + prose(50 + k, 6 * k).split()) for k in range(6)]
    out = minhash_forest.group_documents(frame(spark, texts), 5, 80).collect()
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if similar(texts[i], texts[j], 5):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {r.doc_id: r.component_id for r in out} == {i: find(i) for i in range(len(texts))}
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    kept = minhash_forest.drop_copies(frame(spark, texts))
    assert kept.columns == frame(spark, texts).columns and kept.count() == sum(find(i) == i for i in range(len(texts)))
    alone = minhash_forest.group_documents(frame(spark, ["a b c d e f", None, "a b c d e f"], ids=[None, None, 4])).collect()
    assert all(r.kept for r in alone) and len(alone) == 3
    assert minhash_forest.group_documents(frame(spark, []).limit(0)).count() == 0


def test_blocks_of_a_dense_region():
    import pandas as pd

    texts = [edited(prose(20, 200), k, 3) for k in range(30)]
    hashes = minhash_forest.WordHashes()
    sets = [minhash_forest.shingle_set(hashes.of(minhash_forest.lowered_words(t)), 5) for t in texts]
    trees = [minhash_forest.forest(s) for s in sets]
    found = set()
    for tree in range(minhash_forest.TREES):
        by_root = defaultdict(list)
        for i, f in enumerate(trees):
            by_root[f[tree * 24:tree * 24 + 10]].append(i)
        for root, ids in by_root.items():
            m = pd.DataFrame({"id": ids, "component": ids, "forest": [trees[i] for i in ids], "text": [texts[i] for i in ids],
                              "region": [bytes([tree]) + root] * len(ids), "block": 0, "low": 0, "high": 0})
            found |= set(minhash_forest.linked_in_blocks(m, 5, 80).itertuples(index=False, name=None))
    assert found and all(similar(texts[a], texts[b], 5) for a, b in found)


def test_decontamination(spark):
    items = [prose(100 + k, n, 3000) for k, n in enumerate((3, 12, 20, 33, 65, 120))] + [None, ""]
    long_edit = items[4].split()
    long_edit[30] = "changed"
    texts = list(ODD) + [f"{prose(200 + k, 90)} {t} {prose(300 + k, 50)}" for k, t in enumerate(items[:6])]
    texts += [items[3].upper() + "!", f"{prose(400, 30)} {' '.join(long_edit)} {prose(401, 30)}", items[5][:len(items[5]) // 2]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    out = decontamination.find_items(frame(spark, texts), bench)
    n = len(ODD)
    assert {(r.doc_id, r.item_id) for r in out.collect()} == {*((n + k, k) for k in range(6)), (n + 6, 3), (n + 7, 4)}
    clean = decontamination.drop_contaminated(frame(spark, texts), bench)
    assert clean.columns == frame(spark, texts).columns and {r.doc_id for r in clean.collect()} == {*range(n), n + 8}
    assert decontamination.find_items(frame(spark, texts), bench.limit(0)).count() == 0
    assert decontamination.find_items(frame(spark, []).limit(0), bench).count() == 0


def test_decontamination_at_the_ends_of_items(spark):
    """Copies whose first, last or inner words are changed, as far as 0.8 allows, at all alignments of the windows."""
    bench, texts, want = [], [], set()
    for item, n in enumerate((17, 24, 35, 37, 47, 48, 60)):
        words = prose(500 + item, n, 5000).split()
        bench.append((item, " ".join(words)))
        lost = (n - 4) // 9
        edits = [set(range(lost)), set(range(n - lost, n)), {k for k in range(lost // 2)} | {n - 1 - k for k in range(lost - lost // 2)}]
        edits += [{n // 2}] if lost >= 5 else []
        for places in edits:
            for before in range(0, 24, 3):
                want.add((len(texts), item))
                copy = " ".join(f"y{k}" if k in places else w for k, w in enumerate(words))
                texts.append(f"{prose(9000 + len(texts), 40 + before, 5000)} {copy} {prose(7000 + len(texts), 30, 5000)}")
    out = decontamination.find_items(frame(spark, texts), spark.createDataFrame(bench, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in out}
    assert len(want - found) <= 0.01 * len(want) and found <= want, sorted(want - found)


def test_documents_without_id(spark):
    item = prose(77, 40, 3000)
    docs = frame(spark, [item, prose(1, 60), None, f"{prose(2, 60)} {item}", prose(3, 60)], ids=[None, None, None, 4, 5])
    clean = decontamination.drop_contaminated(docs, spark.createDataFrame([(0, item)], "item_id long, text string"))
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted([(0, prose(1, 60)), (0, ""), (5, prose(3, 60))])
    shared = prose(88, 80, 3000)
    texts = [f"{prose(4, 30)} {shared} {prose(5, 30)}", f"{prose(6, 20)} {shared}", f"{shared} {prose(7, 9)}"]
    out = repeated_passages.repeated_passages(frame(spark, texts + [None, prose(8, 70)], ids=[None, 3, None, None, None]))
    assert sorted((r.doc_id or 0, r.start, r.end) for r in out.collect()) == [(0, 0, 80), (0, 30, 110), (3, 20, 100)]


def test_decontamination_of_repeated_items(spark, monkeypatch):
    passage = prose(110, 60, 3000).split()
    near = " ".join(passage[:30] + ["changed"] + passage[31:])
    template = prose(111, 50, 3000)
    items = [" ".join(passage)] * 10 + [f"{template} {prose(112 + k, 10, 3000)}" for k in range(4)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    edit = items[11].split()
    edit[52] = "changed"
    texts = [f"{prose(210 + k, 40)} {t} {prose(310 + k, 40)}" for k, t in enumerate((near, " ".join(edit), items[0], prose(410, 60, 3000)))]
    found = {}
    for bound in (20_000, 3):
        monkeypatch.setattr(decontamination, "SLICE_ITEMS", bound)
        found[bound] = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontamination.find_items(frame(spark, texts), bench).collect()}
    assert found[20_000] == found[3]
    assert set(found[3]) >= {*((0, k) for k in range(10)), (1, 11), *((2, k) for k in range(10))}
    assert not any(doc == 3 for doc, _ in found[3]) and found[3][0, 0] == pytest.approx(51 / 61)


def test_fingerprint_blocks_find_every_close_pair():
    index = decontamination.Index([(1, prose(1, 40)), (2, prose(2, 40))])
    (size, (marks, owner, offset, tables)), = index.sizes.items()
    rng = np.random.default_rng(1)
    for mark in marks:
        for _ in range(20):
            flipped = mark ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, decontamination.RADIUS, replace=False).astype(np.uint64))
            blocks = np.array([flipped]).view("<u2")
            assert any(mark in marks[entries[ends[b]:ends[int(b) + 1]]] for b, (ends, entries) in zip(blocks, tables, strict=True))


def test_mixing(spark):
    sources = ["big"] * 300 + ["mid"] * 60 + ["tiny"] * 3 + [None] * 20
    texts = [prose(k, 20 + k % 300) for k in range(len(sources))]
    texts[5], texts[6] = None, ""
    docs = frame(spark, texts, sources)
    out = mixing.copies(docs).collect()
    size = Counter()
    for t, s in zip(texts, sources, strict=True):
        size[s] += len(words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight, total = {s: k % 3 + 1 for k, s in enumerate(order)}, sum(size.values())
    wanted, free = {}, set(order)
    while free:
        share = (total - sum(wanted.values())) / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * size[s]}
        wanted |= {s: 3 * size[s] for s in over} if over else {s: share * weight[s] for s in free}
        free -= over or free
    taken = Counter()
    for r in out:
        assert r.size == len(words(texts[r.doc_id])) and 0 <= r.copies <= 3 and r.source_size == size[sources[r.doc_id]]
        assert r.target == pytest.approx(wanted[sources[r.doc_id]])
        taken[sources[r.doc_id]] += r.copies * r.size
    assert all(abs(taken[s] - wanted[s]) <= max(40, 0.02 * wanted[s]) for s in order)
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.copies(docs.repartition(7)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out if r.size)
    assert mixing.copies(frame(spark, []).limit(0)).count() == 0


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = list(ODD) + ["<|endoftext|>a b<|startoftext|>", "don't stop!!", "naïve space x"]
    ids = [5, 5, None, *range(10, 10 + len(texts) - 3)]
    folder = scratch_dir(spark, "tokens-test")
    token_files.write_tokens(frame(spark, texts, ids=ids), folder, path, end_id=2)
    tokenizer = Tokenizer.from_file(path)
    want = sorted((-1 if i is None else i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in zip(ids, texts, strict=True))
    got = sorted((r.start, -1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in token_files.read_tokens(spark, folder).collect())
    assert [(i, x) for _, i, x in got] == want
    assert [s for s, _, _ in got] == [sum(len(x) for _, x in want[:k]) for k in range(len(want))]
    empty = scratch_dir(spark, "tokens-empty")
    token_files.write_tokens(frame(spark, []).limit(0), empty, path, end_id=2)
    assert token_files.read_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_byte_aligned_coding(n):
    ranks = np.random.default_rng(n).integers(0, 1 << np.random.default_rng(n + 1).integers(1, 32, n), n).astype(np.uint32) if n else np.zeros(0, np.uint32)
    control, data = token_files.pack(ranks)
    assert (token_files.unpack(control, data, n) == ranks).all() and len(control) == -(-n // 4)


def test_line_dedup(spark):
    shared, often = "This line is shared", "boilerplate footer line"
    texts = list(ODD) + [f"{shared}\nown {k} line here\n\t{often.upper()} \nshort\n{often}" for k in range(30)] + [None, often]
    ids = [*range(len(texts) - 2), None, 3]
    out = line_dedup.dedup_lines(frame(spark, texts, ids=ids), batches=3).collect()
    key = lambda x: re.sub(f"^{SPACE}|{SPACE}$", "", x).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    owner = {}
    for i, t in zip(ids, texts, strict=True):
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 10:
                owner[key(x)] = min(i, owner.get(key(x), i))
    want = []
    for i, t in zip(ids, texts, strict=True):
        every = (t or "").split("\n")
        kept = [x for x in every if i is None or owner.get(key(x), i) == i]
        want.append((-1 if i is None else i, "\n".join(kept), len(every), len(every) - len(kept)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out) == sorted(want)
    assert line_dedup.dedup_lines(frame(spark, []).limit(0)).count() == 0


def test_line_store_levels(spark):
    store = line_dedup.LineStore(spark, buckets=2, fanout=2)
    for k in range(5):
        store.add(spark.range(k * 10, k * 10 + 15).selectExpr("id AS h1", "id AS h2", f"{k} AS doc_id"))
    assert [len(level) for level in store.levels] == [1, 0, 1]
    owners = {r.h1: r.owner for run in store.runs() for r in run.collect()}
    assert owners == {i: min(max(i - 5, 0) // 10, 4) for i in range(55)}
    store.close()


def test_repeated_passages(spark):
    passage, short = prose(500, 70, 9000), prose(501, 45, 9000)
    texts = list(ODD) + [f"{prose(600 + k, 80, 9000)} {passage} {prose(700 + k, 60, 9000)}" for k in range(12)]
    texts += [f"{prose(800 + k, 60, 9000)} {short} {prose(900 + k, 60, 9000)}" for k in range(5)] + [passage, prose(1000, 300, 9000)]
    out = repeated_passages.repeated_passages(frame(spark, texts)).collect()
    seen = defaultdict(set)
    for i, t in enumerate(texts):
        w = words((t or "").lower())
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].add(i)
    want = {(i, p) for i, t in enumerate(texts) for w in [words((t or "").lower())] for k in range(len(w) - 49) if len(seen[tuple(w[k:k + 50])]) > 1 for p in range(k, k + 50)}
    assert {(r.doc_id, p) for r in out for p in range(r.start, r.end)} == want
    assert repeated_passages.repeated_passages(frame(spark, []).limit(0)).count() == 0


def test_repeated_passages_in_crowded_runs(spark):
    passage, line = prose(1100, 60, 9000), prose(1101, 40, 9000)
    texts = [" ".join(f"{passage} {prose(1200 + k, 5, 9000)}" for k in range(40)), f"{prose(1300, 30, 9000)} {passage} {prose(1301, 30, 9000)}"]
    for k in range(120):  # all share the line, every two of the first 40 also the 12 words before it
        lead = prose(1400 + k // 2, 12, 9000) if k < 40 else prose(1500 + k, 12, 9000)
        texts.append(f"{prose(1700 + k, 40, 9000)} {lead} {line} {prose(1900 + k, 40, 9000)}")
    out = repeated_passages.repeated_passages(frame(spark, texts)).collect()
    seen = defaultdict(set)
    for i, t in enumerate(texts):
        w = words(t)
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].add(i)
    want = {(i, p) for i, t in enumerate(texts) for w in [words(t)] for k in range(len(w) - 49) if len(seen[tuple(w[k:k + 50])]) > 1 for p in range(k, k + 50)}
    assert {i for i, _ in want} == set(range(42)) and sum(i == 0 for i, _ in want) == 2400
    assert {(r.doc_id, p) for r in out for p in range(r.start, r.end)} == want


def test_language_id(spark):
    tongues = {"aa": "kala mino petu", "bb": "strö wük zzy", "cc": "ñandú qué llo"}
    rows = [(i, " ".join(random.Random(i).choices(tongues[lang].split(), k=30)), lang) for i in range(60) for lang in [list(tongues)[i % 3]]]
    labelled = spark.createDataFrame(rows + [(99, "kala", None)], "doc_id long, text string, lang string")
    languages, model = language_id.learn(labelled)
    assert languages == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in language_id.identify(frame(spark, [*ODD, "mino kala", "123 456 !!"]), languages, model).collect()}
    assert found[len(ODD)].lang_pred == "aa" and all(0 <= r.score <= 1 for r in found.values())
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {0, 1, 2, 3, len(ODD) + 1}
    nothing = language_id.learn(labelled.limit(0))
    assert {r.lang_pred for r in language_id.identify(frame(spark, ODD), *nothing).collect()} == {"und"}


def test_quality_classifier(spark):
    texts = [prose(k, 150) if k % 2 else " ".join(w.upper() + "!!" for w in prose(k, 150).split()) for k in range(400)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, label int")
    model = quality_classifier.fit(docs, labels)
    scores = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    assert np.mean([(scores[k] >= 0.5) == bool(k % 2) for k in range(300, 400)]) > 0.97
    odd = quality_classifier.score(frame(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality_classifier.fit(docs, labels.where("label = 1")) is None
    assert {r.score for r in quality_classifier.score(docs, None).collect()} == {0.5}


def test_quality_scores_do_not_depend_on_the_sample_bound(spark, monkeypatch):
    r, texts, labels = random.Random(9), [], []
    for k in range(1200):  # plain texts are labelled good with probability 0.97, loud ones with 0.7
        t, plain = prose(k, 100), k % 2
        texts.append(t if plain else " ".join(w.upper() + "!!" for w in t.split()))
        labels.append((k, int(r.random() < (0.97 if plain else 0.7))))
    docs, given = frame(spark, texts), spark.createDataFrame(labels, "doc_id long, label int")
    bad = sum(1 - y for _, y in labels)
    assert 4 * bad < len(texts)
    scores = {}
    for bound in (1500, 80):  # 80 cuts the good side, and the other one little
        monkeypatch.setattr(quality_classifier, "SAMPLE_ROWS", bound)
        scores[bound] = {x.doc_id: x.score for x in quality_classifier.score(docs, quality_classifier.fit(docs, given)).collect()}
    for plain in (0, 1):
        some = [k for k in range(1200) if k % 2 == plain]
        assert abs(np.mean([scores[1500][k] for k in some]) - np.mean([scores[80][k] for k in some])) < 0.06
    assert np.mean([scores[80][k] for k in range(0, 1200, 2)]) == pytest.approx(0.7, abs=0.08)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, match):
    digits = [int(d) for d in re.sub("[^0-9]", "", match)]
    luhn = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits))) % 10 == 0
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")), "card": 14 <= len(digits) <= 19 and luhn,
            "phone": 10 <= len(digits) <= 15}[kind]


def test_personal_data(spark):
    texts = list(ODD) + [
        "mail a.b@c-d.org,x@y no@dot a@b.c%d@e.f é@x.yz", "1.2.3.4.5.6.7.8 256.1.1.1 0010.2.3.4 9.9.9", "4111 1111-1111 1111 4111111111111112 é 378282246310005",
        "+1 (743) 555-3824 +12 +1........2 +49 30 1234567 890 12 345 6", "1" * 20_000, "a" * 20_000 + "@", "1 " * 5_000, "+1(", "@@..@", "ü+1 212 555 0100 a@b.co"]
    out = personal_data.find_personal_data(frame(spark, texts)).collect()
    for r in out:
        text = texts[r.doc_id] or ""
        want = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if passes(kind, m.group()))
        assert r.base_spans == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in want), text[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in want) for k in PATTERNS]
        assert set(r.base_spans.split(",")) <= set(r.spans.split(",")) | {""}
    assert personal_data.find_personal_data(frame(spark, []).limit(0)).count() == 0


def test_personal_data_adds_likely_spans(spark):
    r = random.Random(4)
    lead = ["please call", "reach us under", "the office, room", "write soon to", "ask them about", "send one copy to"]

    def line(span):
        return f"{prose(r.random(), 4)} {r.choice(lead)} {span} {prose(r.random(), 5)}"

    def number():
        return r.randrange(200, 999), r.randrange(200, 999), r.randrange(1000, 9999)

    known = [line("+1 (%d) %d-%d" % number()) for _ in range(300)] + [line(f"u{r.randrange(99)}.n@mail{r.randrange(9)}.example.com") for _ in range(300)]
    plain = [line(f"{r.randrange(10**7, 10**8)} of {r.randrange(10)}") for _ in range(300)] + [line(f"{r.randrange(10**9, 10**10)}") for _ in range(100)]
    plain += [line(f"19{r.randrange(10, 99)}-0{r.randrange(1, 9)}-1{r.randrange(9)}") for _ in range(200)] + [f"we looked (at) trees. Then {prose(r.random(), 5)}" for _ in range(50)]
    wide = [("phone", "(%d) %d-%d" % number()) for _ in range(50)] + [("phone", "%d-%d-%d" % number()) for _ in range(50)]
    wide += [("email", f"bob{r.randrange(99)} (at) host{r.randrange(9)} (dot) org") for _ in range(50)]
    texts = known + plain + [line(span) for _, span in wide]
    out = {x.doc_id: x for x in personal_data.find_personal_data(frame(spark, texts)).collect()}
    assert sum(x.n_phone for x in out.values()) == sum(x.n_email for x in out.values()) == 300
    first = len(known) + len(plain)
    hits = 0
    for k, (kind, span) in enumerate(wide, first):
        at = texts[k].index(span)
        hits += f"{kind}:{at}:{at + len(span)}" in out[k].spans.split(",")
    wrong = sum(out[k].spans != out[k].base_spans for k in range(len(known), first))
    assert hits >= 0.95 * len(wide) and wrong <= 0.02 * len(plain), (hits, wrong)
    assert all(x.n_spans == len([s for s in x.spans.split(",") if s]) for x in out.values())


def test_pipeline(spark):
    import corpus_pipeline

    base = scratch_dir(spark, "pipeline-test")
    item = prose(77, 40, 3000)
    texts = list(ODD) + [prose(2000 + k, 120, 3000) for k in range(30)] + [prose(2000, 120, 3000), f"{prose(3000, 60, 3000)} {item} {prose(3001, 60, 3000)}", "buy " * 100]
    docs = frame(spark, texts, [f"s{k % 3}" for k in range(len(texts))])
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    step = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        step = stage(spark, step, base)
        assert step.columns == docs.columns, name
    ids = Counter(r.doc_id for r in step.collect())
    first = len(ODD)
    assert set(ids) <= {7, 8, *range(first, first + 30)} and max(ids.values()) <= 3
    out = corpus_pipeline.run(spark, base)
    assert Counter(r.doc_id for r in out.collect()) == ids and out.agg(F.min("start")).first()[0] == 0
