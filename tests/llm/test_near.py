"""The pipeline's near-dedup stage against brute force over whole shingle sets."""

import random

import numpy as np
import pytest

from convolens.llm import shingles

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(texts):
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    low = {i: i for i in texts}
    near = [(a, b) for a in texts for b in texts if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return {i for i in texts if low[i] == i}


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"x{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("block", [256, 8])
def test_near_copies_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(shingles, "BLOCK", block)
    rng = random.Random(4)
    line = [f"common{i}" for i in range(30)]
    texts, big = [], [f"b{i}" for i in range(150)]
    for i in range(60):
        base = [f"w{i}_{j}" for j in range(rng.choice((1, 3, 5, 6, 40, 150, 400)))]
        texts += [base, edited(rng, base, len(base) // 60), edited(rng, base, len(base) // 35), edited(rng, base, len(base) // 20)]
        texts.append([*line, *base[:20]])
    texts += [edited(rng, big, rng.choice((1, 2, 3, 4))) for _ in range(60)]  # one large group that no single leader connects
    rng.shuffle(texts)
    texts = {i: " ".join(t) for i, t in enumerate([*texts, [], [], ["ONE"], ["one"]])}
    kept = plain_kept(texts)
    assert len(kept) < len(texts) - 100
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts.items()], SCHEMA).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, None)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == kept


def test_near_copies_of_dirty_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "a b c"), (4, "A b  c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in shingles.keep_first(docs).collect()) == [0, 1, 3, 3]
    assert shingles.keep_first(docs.limit(0)).count() == 0


def test_cells_lose_no_link():
    """Sets of every size, at any similarity from 4/5 on, share a cell that at least one of them has for its own class."""
    rng = np.random.default_rng(0)
    some = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    for n in [*range(4, 40), 60, 100, 300, 1000] * 3:
        a = np.unique(some(n))
        kept = a[rng.permutation(n)[: rng.integers((4 * n + 4) // 5, n + 1)]]
        b = np.unique(np.concatenate([kept, some(rng.integers(0, max(0, 9 * len(kept) // 4 - n - len(kept)) + 1))]))
        assert 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))
        cells = shingles.cells([a, b])
        shared = np.intersect1d(*[np.unique(x >> 1) for x in cells])
        own = np.concatenate([x[x & 1 == 1] >> 1 for x in cells])
        assert np.isin(shared, own).any() or len(a) == len(b) == len(kept)
        counts = [np.bincount((x >> np.uint64(64 - shingles.COARSE_BITS)).astype(int), minlength=1 << shingles.COARSE_BITS) for x in (a, b)]
        around = np.minimum((counts[0] - counts[1]) % 4, (counts[1] - counts[0]) % 4).sum()
        one, two = (shingles._words_of([shingles._coarse(x)]) for x in (a, b))
        assert shingles._least_distance(one, two).tolist() == [around] and around <= len(np.setxor1d(a, b))


def test_shingles_of_a_batch_are_those_of_each_text():
    texts = ["a b c d e f g", None, "", "A b c", "x " * 300, "a B c d e f g h", "c"]
    whole = shingles.shingles(texts)
    assert [len(x) for x in whole] == [3, 0, 0, 1, 1, 4, 1]
    assert all((x == shingles.shingles([t])[0]).all() for x, t in zip(whole, texts, strict=True))
    assert len(np.intersect1d(whole[0], whole[5])) == 3


def test_cells_of_several_tasks_are_wanted_as_by_brute_force(monkeypatch):
    """However the texts are dealt to tasks, a cell stays if several sets share it and one has it for its own class."""
    import pyarrow as pa
    import pyarrow.compute

    rng = random.Random(2)
    base = [[f"w{i}_{j}" for j in range(rng.choice((8, 30, 90)))] for i in range(12)]
    texts = [" ".join(edited(rng, b, rng.randrange(3))) for b in base for _ in range(4)] + [" ".join(base[0])] * 3
    sets = {shingles._node(s): s for s in shingles.shingles(texts)}
    plain = {}
    for node, of in sets.items():
        for c in shingles.cells([of])[0].tolist():
            plain.setdefault((c >> 1) & (1 << 63) - 1, set()).add((node, bool(c & 1)))
    short = lambda key: key >> 63 - shingles.KEY_BITS
    wanted = {(short(key), *x) for key, rows in plain.items() if len(rows) > 1 and any(own for _, own in rows) for x in rows}
    for cells, tasks in ((1 << 20, 1), (1 << 20, 3), (50, 4)):
        monkeypatch.setattr(shingles, "CELLS", cells)
        monkeypatch.setattr(shingles, "BATCH", 100)
        dealt = [b for i in range(tasks) for b in shingles._dealt_cells(iter([pa.record_batch([pa.array(texts[i::tasks])], names=["text"])]), 8)]
        rows = pa.Table.from_batches(dealt)
        got = set()
        for group in range(8):
            part = rows.filter(pa.compute.equal(rows["group"], group))
            got |= {(r["key"], r["node"], r["own"]) for b in shingles._wanted_cells(iter(part.to_batches())) for r in b.to_pylist()}
        assert got == wanted


def test_fine_counts_never_exceed_the_distance():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 63, 64, 100, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate([a[: rng.integers(0, n + 1)], rng.integers(0, 2**63, rng.integers(0, n + 1)).astype(np.uint64)]))
        assert shingles._fine_distance(shingles._fine(a), shingles._fine(b)) <= len(np.setxor1d(a, b))
        assert shingles._fine_distance(shingles._fine(a), shingles._fine(a)) == 0


def test_simhash_proposes_the_pairs_of_close_fingerprints(spark):
    """Nodes of equal fingerprint and of fingerprints within 3 bits; sets without shingles take no part."""
    far = 0x0F0F0F0F0F0F0F0F
    rows = [(1, 9, 0), (2, 9, 7), (5, 9, far), (9, 9, far), (4, 0, far), (8, 9, -1)]
    got = shingles._print_pairs(spark.createDataFrame(rows, "node long, size int, fp long"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (5, 9)]


def test_fingerprint_of_a_set_is_the_majority_of_its_shingles():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 300):
        own = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64))
        plain = sum(1 << i for i in range(64) if 2 * sum(int(x) >> i & 1 for x in own) > len(own))
        assert shingles._print(own) % 2**64 == plain


def test_wanted_cells_are_found_in_little_memory(monkeypatch):
    """A task holds the cells of its groups in 16 bytes each, and what it needs to sort them for a range of numbers only."""
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(shingles, "CELLS", 1 << 14)
    rng, n, width = np.random.default_rng(5), 20_000, (shingles.KEY_BITS + 2) // 8
    rows, plain = [], set()
    for node in range(25):
        number = np.sort(rng.integers(0, 1 << shingles.KEY_BITS, n).astype(np.uint64))
        number[:: n // 4] = [i << shingles.KEY_BITS - 2 for i in range(4)]  # four cells that all rows have
        number.sort()
        rows.append((np.ascontiguousarray((number << np.uint64(2) | np.uint64(2)).view(np.uint8).reshape(-1, 8)[:, :width]).T.tobytes(), np.full(n, node).tobytes()))
        plain |= {(x, node) for x in number.tolist()}
    uses = {}
    for x, node in plain:
        uses.setdefault(x, []).append(node)
    batches = [pa.record_batch([pa.array([0], pa.int32()), pa.array([x]), pa.array([y])], names=["group", "cells", "nodes"]) for x, y in rows]
    tracemalloc.start()
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in shingles._wanted_cells(iter(batches))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = [x for key, node in got for x in zip(key.tolist(), node.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == {(x, node) for x, nodes in uses.items() if len(nodes) > 1 for node in nodes}
    assert len(found) >= 25 and peak < 40 * 25 * n, peak
