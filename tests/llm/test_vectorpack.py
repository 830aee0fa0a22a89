"""Vector packing: round trips, limits, and no padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from reefgrid.llm import vectorpack
from reefgrid.llm.vectorpack import Item, Limits, Packer, instruction_examples, pack_examples


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vectorpack.tokenizer_path())


def checked(rows, examples, limits, prompts=()):
    """Pieces cover every example once and sequences keep all limits and are not padded."""
    encode = lambda t: tokenizer().encode(t or "", add_special_tokens=False).ids
    whole = defaultdict(list)
    for i, (doc, text) in enumerate(examples):
        ahead = encode(prompts[i]) if prompts else []
        whole[doc].append((ahead + encode(text) + [2], len(ahead)))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens, r.loss, ids))
    for rs in sequences.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.segment for r in rs] == list(range(len(rs)))
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
        size = sum(r.length for r in rs)
        assert len(rs) <= limits.segments and sum(r.loss for r in rs) <= limits.loss
        assert size == limits.tokens or (size < limits.tokens and size & (size - 1) == 0)
    assert pieces.keys() == whole.keys()
    for doc, examples_ in whole.items():
        if len(examples_) == 1:  # rows of one id are told apart by their totals only
            ids, prompt = examples_[0]
            at = 0
            for start, length, total, loss, part in sorted(pieces[doc]):
                assert start == at and total == len(ids) and part == ids[at : at + length]
                at += length
                assert loss == max(0, at - max(start, prompt))
            assert at == len(ids)
        assert sum(p[1] for p in pieces[doc]) == sum(len(x) for x, _ in examples_)
    return sequences


@pytest.mark.parametrize("meeting", [2, 64])
def test_round_trip(spark, docs, monkeypatch, meeting):
    monkeypatch.setattr(vectorpack, "MEETING", meeting)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "thonder", "ré", "12,5", "ß"], k=rng.choice([0, 1, 3, 40, 300])))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "w " * 9000), (7, rows[7][1])]
    limits = Limits(tokens=256, segments=20, loss=256)
    table = docs(rows, "ids,start,part").repartition(7)
    found = pack_examples(table, limits, with_ids=True).collect()
    sequences = checked(found, rows, limits)
    total = sum(r.length for r in found)
    assert len(sequences) <= total // 256 + 20  # almost all are full
    assert pack_examples(docs([])).collect() == []


def test_conversations_under_three_limits(spark):
    rng = random.Random(2)
    say = lambda k: " ".join(rng.choices(["please", "explain", "yes"], k=k))
    turns = [(c, t, "assistant" if t % 2 else "user", say(rng.randint(0, 60))) for c in range(60) for t in range(rng.randint(1, 6))]
    turns += [(0, 1, "assistant", None), (0, 0, "user", "zzz again"), (None, 1, "assistant", "who"), (99, 0, "assistant", "first")]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    examples = instruction_examples(table)
    got = sorted(map(tuple, examples.collect()), key=str)
    first = {}
    for c, t, _, x in turns:
        if c is not None and x is not None:
            first[c, t + 1] = min(x, first.get((c, t + 1), x))
    assert got == sorted(((c, t, first.get((c, t)), x) for c, t, r, x in turns if r == "assistant"), key=str)
    limits = Limits(tokens=128, segments=4, loss=80)
    rows = examples.collect()
    numbered = spark.createDataFrame([(i, r.prompt, r.text) for i, r in enumerate(rows)], "doc_id long, prompt string, text string")
    found = pack_examples(numbered, limits, with_ids=True).collect()
    checked(found, [(i, r.text) for i, r in enumerate(rows)], limits, [r.prompt for r in rows])


def test_the_largest_dot_product_comes_first():
    packer = Packer(Limits(100, 10, 50))
    for i, (tokens, prompt) in enumerate([(40, 40), (60, 10), (40, 5), (30, 0)]):
        packer.add(Item(i, tokens, 0, prompt, bytes(4 * tokens)))
    pieces, done = packer.sequence(True)
    # 60 tokens with 50 of loss use up the loss; only what bears none fits with them.
    assert [(p.doc, p.tokens, p.loss) for p in pieces] == [(1, 60, 50), (0, 40, 0)] and done


def test_tiny_examples_leave_the_last_place_to_one_that_fills():
    packer = Packer(Limits(64, 4, 64))
    for i, tokens in enumerate([1] * 9 + [500]):
        packer.add(Item(i, tokens, 0, 0, bytes(4 * tokens)))
    sizes = []
    while not packer.empty():
        pieces, _ = packer.sequence(True)
        sizes.append(sum(p.tokens for p in pieces))
    assert sum(sizes) == 509 and sizes[:7] == [64] * 7
    assert all(s == 64 or s & (s - 1) == 0 for s in sizes)


def test_long_examples_and_a_small_window():
    packer = Packer(Limits(64, 8, 64), window=2, window_tokens=100)
    for i, tokens in enumerate([1000, 5, 7, 300, 1, 1, 90]):
        packer.add(Item(i, tokens, 0, 0, bytes(4 * tokens)))
    total = 0
    while not packer.empty():
        total += sum(p.tokens for p in packer.sequence(True)[0])
    assert total == 1404
