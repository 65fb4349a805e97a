"""Alignment of two tokenizers against a plain version."""

from __future__ import annotations

import collections
import hashlib
import random

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import token_alignment as ta
from riskloom.llm.queries import tokenizer_path

PATHS = (tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def rows():
    more = ["x▁y and more", "abc" * 4000, "日本語のテキスト" * 900, "<s> </s> <|endoftext|> <0x41>", " lead  and trail  "]
    more += ["a ▁ b" * 50, "long " * 30000, "　wide  \u0085 blanks\x7f end", "é" * 70000, " ", "\n"]
    return brute.edge_rows() + [(900 + k, t) for k, t in enumerate(more)]


def spelled_a(tokenizer):
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    sign = {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(other)}}
    return lambda k: bytes(sign[c] for c in tokenizer.id_to_token(k))


def spelled_b(pieces):
    def spell(k):
        if pieces.is_byte(k):
            return bytes([int(pieces.id_to_piece(k)[1:-1], 16)])
        return pieces.id_to_piece(k).replace("▁", " ").encode()

    return spell


def plain(given):
    """Rows of the result, from each text's tokens one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    made, held = [], collections.Counter()
    for _, text in given:
        found = None
        if text:
            streams = []
            for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, spelled_a(a)), (b.encode(text), spelled_b(b))):
                end, stream = 0, []
                for k in ids:
                    stream.append((end, end := end + len(spell(k)), k, spell(k)))
                streams.append(stream)
            if all(b"".join(t[3] for t in s) == (" " + text).encode() for s in streams):
                found = walked(*streams)
                held.update(found[1].keys())
        made.append(found)
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), found in zip(given, made):
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        (n_a, n_b, groups), linked = found
        n_best = sum(n for pair, n in linked.items() if held[pair] == most[pair[0]])
        total = sum(n * held[pair] for pair, n in linked.items())
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), sum(linked.values()), n_best, total, digest))
    return sorted(out, key=repr)


def walked(a, b):
    linked, groups, i, j, left = collections.Counter(), [], 0, 0, ([], [])
    while i < len(a) and j < len(b):
        linked[a[i][2], b[j][2]] += 1
        ends = a[i][1], b[j][1]
        if ends[0] <= ends[1]:
            left[0].append(str(a[i][2]))
            i += 1
        if ends[1] <= ends[0]:
            left[1].append(str(b[j][2]))
            j += 1
        if ends[0] == ends[1]:
            groups.append("|".join(map(",".join, left)))
            left = ([], [])
    return (len(a), len(b), groups), linked


@pytest.fixture(scope="module")
def expected():
    return plain(rows())


@pytest.mark.parametrize("size", [ta.RANGE, 700, 20])
def test_alignment_of_awkward_texts(spark, expected, size):
    clashing = "row window node start times pairs docs best total at n_a".split()
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    df = df.select(*[F.lit("z").alias(c) for c in clashing], "*")
    if size == 20:  # the longest texts would make tens of thousands of ranges
        df = df.where("length(text) < 3000 or text is null")
        given = [(i, t) for i, t in rows() if len(t or "") < 3000]
        expected = plain(given)
    found = ta.align(df, *PATHS, size=size)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


def test_alignment_of_the_given_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for size in (ta.RANGE, 2000):
        found = ta.align(docs, *PATHS, size=size)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(given)


def test_alignment_of_no_rows(spark):
    for given in ([], [(1, None)], [(1, ""), (1, "")]):
        df = spark.createDataFrame(given, "doc_id long, text string")
        found = [tuple(r) for r in ta.align(df, *PATHS).collect()]
        assert found == [(1, 0, 0, 0, 0, 0, 0, "")] * len(given)


def test_fragments_compose_in_any_tree():
    """Tokens with random ends, cut into random ranges and composed in random order of neighbours."""
    rng = random.Random(8)
    for _ in range(60):
        size = rng.randint(1, 80)
        ends = [sorted({*rng.sample(range(1, size + 1), rng.randint(0, size - 1)), size}) for _ in range(2)]
        tokens = ta.Tokens.of([[rng.randint(0, 9) for _ in ends[0]], ends[0], [rng.randint(0, 9) for _ in ends[1]], ends[1]])
        cut = [ta.Fragment.cut(part) for _, part in ta._ranges(tokens, rng.randint(1, 30))]
        left = [f for f, _, _ in cut]
        while len(left) > 1:
            at = rng.randrange(len(left) - 1)
            left[at : at + 2] = [left[at] + left[at + 1]]
        whole = left[0]
        assert not len(whole.suffix.a) and not len(whole.suffix.b)
        pieces = whole.groups() + [(start, closed) for _, closed, start in cut if len(closed.a)]
        pieces.sort(key=lambda p: p[0])
        text = "".join(ta.Aligned(t).text()[0] for _, t in pieces)
        links = np.sort(np.concatenate([ta.Aligned(t).pairs for _, t in pieces]))
        straight = ta.Aligned(tokens)
        assert text == straight.text()[0]
        assert (links == np.sort(straight.pairs)).all()


def test_an_empty_fragment_changes_nothing():
    empty = ta.Fragment(ta.none(), ta.none(), -1, [])
    tokens = ta.Tokens.of([[1, 2, 3], [2, 4, 6], [7, 8], [4, 6]])
    own, _, _ = ta.Fragment.cut(tokens)
    for made in (empty + own, own + empty):
        assert ta._open_values(made) == ta._open_values(own)
