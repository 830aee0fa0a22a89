"""Token alignment against a per-document walk with the tokenizers themselves."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reefgrid.llm.alignment import BYTE_TOKENIZER, PIECE_TOKENIZER, ByteTokens, PieceTokens, align_tokens, token_table, tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path(BYTE_TOKENIZER))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_TOKENIZER))


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    letters = [*" \n\t\r\0aeéß▁<>/s0x漢​　　😀ﬁÅ", "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "  ", "́", " the", "tion"]
    return ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(n)]


def walk(texts, tokenizers):
    """Rows of align_tokens without doc_id, one text after the other."""
    first, second = tokenizers
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    letters = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(rest)}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    docs = []
    for text in texts:
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, piece(i)) for i in second.encode(text)] if text else []
        want = (" " + text).encode() if text else b""
        if b"".join(x[1] for x in a) != want or b"".join(x[1] for x in b) != want:
            a = b = []
        ends = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                at += len(x)
                out.append((at, i))
            ends.append(out)
        common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        cuts = list(zip([0, *common], common))
        groups = ";".join("|".join(",".join(str(i) for e, i in side if low < e <= high) for side in ends) for low, high in cuts)
        links = [(i, j) for e, i in ends[0] for f, j in ends[1] if e == f]
        docs.append((len(a), len(b), len(cuts), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    counts = Counter(x for d in docs for x in d[3])
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
            for n_a, n_b, n_groups, links, sha in docs]


def test_against_a_walk(spark, docs, tokenizers):
    texts = odd_texts(150) + ["", None, "The <|endoftext|> cat sat on the mat, the </s> mat.", "Ré 12 345!", "Ré 12 345!", "x" * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, "again the mat"), (None, "no id")]
    want = sorted((((r[0], *w) for r, w in zip(rows, walk([r[1] for r in rows], tokenizers)))), key=str)
    table = docs(rows, "n_a,links,row")
    for pairs in (1 << 20, 0):  # looked up in a broadcast table, and by a join
        found = align_tokens(table, broadcast_pairs=pairs).select(COLUMNS).collect()
        assert sorted(map(tuple, found), key=str) == want
    assert align_tokens(docs([])).collect() == []
    assert len([r for r in want if r[1] == 0]) > 2  # markers in a text, null and empty texts


def test_tokens_of_whole_documents(tokenizers):
    texts = odd_texts(4000, 8) + ["word " * 40_000, "é" * 20_000]
    first, second = ByteTokens(tokenizer_path(BYTE_TOKENIZER)), PieceTokens(tokenizer_path(PIECE_TOKENIZER))
    assert [i.tolist() for i in first.of(texts)[0]] == [e.ids for e in tokenizers[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert second.apart
    ids, same = second.of(texts)
    assert [i.tolist() for i in ids] == tokenizers[1].encode(texts)
    assert same == ["▁" not in t for t in texts]


def test_ends_start_anew_with_every_list():
    ids = [np.array([1, 0, 1]), np.zeros(0, np.int64), np.array([2])]
    assert token_table(ids, np.array([1, 2, 5])).select(["doc", "end"]).to_pydict() == {"doc": [0, 0, 0, 2], "end": [2, 3, 5, 5]}
