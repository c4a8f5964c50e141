"""The methods against brute force: recall, exact round trips and held-out accuracy."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from foliospark.llm import decontaminate, language_id, packing, simhash, token_grammar, tokens
from foliospark.llm.queries import QUERIES
from tests.conftest import SF


def test_passages_with_edits_are_found():
    """Share of windows within the edit bound that the tables find, and nothing beyond the bound."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(14, 60)))) for i in range(80)]
    index = decontaminate.Benchmark(items)
    texts, want = [], []
    for i, text in items * 4:
        ws = text.split()
        most = index.edits[len(ws)]
        n = rng.randint(0, most)
        for _ in range(n):  # substitutions keep the window's length
            ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        texts.append(" ".join(rng.choices(vocabulary, k=60) + ws + rng.choices(vocabulary, k=60)))
        want.append(i)
    found = [{p[0]: p for p in some} for some in index.search(texts)]
    hits = sum(i in f for i, f in zip(want, found))
    assert hits >= 0.97 * len(want)
    assert sum(len(f) for f in found) == hits
    assert all(p[3] <= index.edits[p[2]] for f in found for p in f.values())


def test_inserted_missing_and_cut_words_are_found():
    """Every passage at the limit, whatever the edits, also in documents that end with it or are no more than it; distances against plain dynamic programming."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 60)))) for i in range(80)]
    index = decontaminate.Benchmark(items)
    texts, want = [], []
    for i, text in items * 6:
        ws, most = text.split(), int(decontaminate.EDITS * len(text.split()))
        kind = rng.choice(["insert", "delete", "mixed", "head", "tail"])
        for _ in range(most):
            edit = rng.choice(["insert", "delete", "change"]) if kind == "mixed" else kind
            at = {"head": 0, "tail": len(ws) - 1}.get(edit, rng.randrange(len(ws)))
            ws[at:at + (edit != "insert")] = [] if edit in ("delete", "head", "tail") else ["new"]
        around = [rng.choices(vocabulary, k=rng.choice([0, 50])) for _ in range(2)]
        texts.append(" ".join(around[0] + ws + around[1]))
        want.append(i)

    def free_ends(a, b):
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    for i, text, found in zip(want, texts, index.search(texts)):
        by = {p[0]: p for p in found}
        assert i in by
        assert all(p[3] == free_ends(items[k][1].split(), text.split()) for k, p in by.items())
    assert index.search([" ".join(items[0][1].split()[:-1])])[0][0][3] == 1


def test_edit_distance():
    def plain(a, b):
        d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        return d[-1][-1]

    rng = random.Random(1)
    for _ in range(300):
        a, b, most = rng.choices(range(4), k=rng.randint(0, 12)), rng.choices(range(4), k=rng.randint(0, 12)), rng.randint(0, 6)
        assert decontaminate.edit_distance(a, b, most) == min(plain(a, b), most + 1)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cut_texts_give_the_library_ids(name):
    rng = random.Random(1)
    letters = list("abcXYZé ñß  \n\t.,'!-_09") + ["'s", "'ll", "́", "αβ", "中", "\xa0", " ", "\x1c", "İ", "Σ", "😀", "\n\n", "<|endoftext|>", "ﬁ", "²"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in tokens.Encoder(public_tokenizers.path(name)).encode(texts)] == want


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    phrases = [rng.integers(0, 900, rng.integers(3, 30)) for _ in range(40)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 40, 4000)]).astype(np.uint32)
    data = token_grammar.pack_shard(ids, [len(ids)])
    shard = token_grammar.Shard(data)
    assert len(data) < len(ids)  # of four bytes each
    assert (shard.ids() == ids).all()
    for start, n in [(0, 1), (len(ids) - 1, 1), (len(ids), 5), *[(int(a), int(b)) for a, b in rng.integers(0, 500, (50, 2)) * 7]]:
        assert (shard.ids(start, n) == ids[start:start + n]).all()
    for some in (np.zeros(0), np.array([7]), np.full(1000, 3), np.arange(50)):
        assert (token_grammar.Shard(token_grammar.pack_shard(some.astype(np.uint32), [len(some)])).ids() == some).all()


def test_packing_reaches_the_bound():
    rng = random.Random(4)
    lengths = [min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000)]
    made = packing.Bins(lengths, 2048)
    made.best_fit()
    first = sum(bool(b) for b in made.bins)
    made.local_search()
    assert sorted(i for b in made.bins for i in b) == list(range(3000))
    assert all(sum(lengths[i] for i in b) == 2048 - f for b, f in zip(made.bins, made.free)) and min(made.free) >= 0
    assert -(-sum(lengths) // 2048) <= sum(bool(b) for b in made.bins) <= min(first, -(-sum(lengths) // 2048) + 1)


def test_search_empties_a_bin_that_best_fit_leaves():
    made = packing.Bins([6, 4, 4, 3, 3], 10)
    made.bins, made.free = [[0, 3], [1, 4], [2]], [1, 3, 6]
    made.local_search()
    assert sum(bool(b) for b in made.bins) == 2


def test_held_out_languages(ready_spark):
    docs = ready_spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op6_language_id"](ready_spark, SF).join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 30 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_languages_that_were_not_learned_go(ready_spark):
    """Other scripts and random letters are turned down, clean documents stay."""
    docs = ready_spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and text is not null").select("doc_id", "text", "lang")
    rng = random.Random(1)
    other = ["Это совсем другой язык, и его никто здесь не учил. " * 4, "这是一个完全不同的语言，没有人学过它。" * 5, "これは誰も学んでいない言語です。" * 5, "Αυτή είναι μια άλλη γλώσσα που κανείς δεν έμαθε. " * 4]
    other += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)) for n in (20, 100, 400)]
    mixed = docs.unionByName(ready_spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(other)], docs.schema))
    kept = {r["doc_id"] for r in language_id.accepted(mixed, language_id.fit(docs)).collect()}
    assert min(kept) >= 0 and len(kept) > 0.97 * docs.select("doc_id").distinct().count()


def test_components_of_planted_fingerprints(ready_spark):
    """Against all pairs, with a dense group, bit flips across both segments, and chains."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(150)}
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)}
    for p in list(prints)[:60]:
        prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        prints.add(p ^ (3 << rng.randrange(62)))
        prints.add(p ^ (7 << rng.randrange(61)))
    prints = sorted(prints)
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = ready_spark.createDataFrame([(i, [signed(p)]) for i, p in enumerate(prints)], "doc_id bigint, fp array<bigint>")
    got = {r["fp"][0]: r["component_id"] for r in simhash.classes(frame).collect()}
    assert got == {signed(p): find(i) for i, p in enumerate(prints)}


def test_all_copies_of_four_fifths_and_no_others_go(ready_spark):
    """Against the exact similarity of all pairs: pairs around the limit, chains, a large group, and a passage that many share."""
    rng = random.Random(8)
    new = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, base, docs = new(40), new(150), []
    for _ in range(60):
        ws = new(rng.randint(30, 160))
        docs += [ws, [*ws], [*ws]]
        for copy, edits in ((docs[-2], rng.randint(1, max(1, len(ws) // 40 + 1))), (docs[-1], rng.randint(1, 4))):
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "new"
    for k in range(60):
        docs += [new(60) + passage, base[:k] + ["x", f"y{k}"] + base[k:]]
    docs += [["one", "two"], ["One", "two"], ["one", "three"]]
    sets = [{tuple(x.lower() for x in d[i:i + 5]) for i in range(max(1, len(d) - 4))} for d in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i in range(len(docs)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
                links += 1
    frame = ready_spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id bigint, text string")
    kept = {r["doc_id"] for r in simhash.one_of_each(frame).collect()}
    assert links > 100 and kept == {find(i) for i in range(len(docs))}
