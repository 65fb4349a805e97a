"""Operators on single texts against plain versions."""

from __future__ import annotations

import collections
import struct
import zlib

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import batches, decontaminate, packing, pii_crf, quality_rules
from riskloom.llm.queries import tokenizer_path


def by_id(rows, names):
    """Rows as sorted tuples, which IDs that repeat or lack leave comparable."""
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_words_and_hashes_of_batches():
    texts = ["", "ab  c", None, "c", " d\n", "ab" * 10, "é x"]
    found = []
    for first, _, data, offsets in batches.text_groups(pa.array(texts), 8):
        rows, starts, ends = batches.words_of(data, offsets, batches.NOT_SPACE)
        hashes = batches.hash_slices(data, starts, ends)
        raw = data.tobytes()
        found += [(first + r, raw[a:b].decode(), int(h)) for r, a, b, h in zip(rows, starts, ends, hashes)]
    words = [(r, w) for r, w, _ in found]
    assert words == [(k, w) for k, t in enumerate(texts) for w in (t or "").split()]
    assert len({(w, h) for _, w, h in found}) == len({w for _, w in words}) == len({h for *_, h in found})


def test_hash_slots_against_a_dictionary():
    rng = np.random.default_rng(2)
    slots, plain = batches.HashSlots(10), {}
    for _ in range(5):
        keys = np.unique(rng.integers(0, 1 << 62, 100, dtype=np.uint64) << np.uint64(2))  # few low bits
        new = np.array([k for k in [2, *keys.tolist()] if k not in plain], np.uint64)
        numbers = np.arange(len(plain), len(plain) + len(new), dtype=np.int32)
        slots.add(new, numbers)
        plain |= dict(zip(new.tolist(), numbers.tolist()))
        asked = np.concatenate((np.array(list(plain), np.uint64), rng.integers(0, 1 << 62, 50, dtype=np.uint64)))
        assert slots.find(asked).tolist() == [plain.get(k, -1) for k in asked.tolist()]


def test_no_column_is_taken_twice():
    assert batches.free_name(["A", "a_", "b"], "a") == "a__" and batches.free_name([], "a") == "a"


# --- personal data ---


def test_personal_data_of_awkward_texts(edge):
    rows, docs = edge
    found = pii_crf.find(docs, pii_crf.fitted()).collect()
    expected = []
    for doc_id, text in rows:
        base = brute.pii_base(text)
        counts = [sum(s[0] == k for s in base) for k in pii_crf.KINDS]
        expected.append((doc_id, *counts, brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))))
    names = ["doc_id", *(f"n_{k}" for k in pii_crf.KINDS), "base_sha256"]
    assert by_id(found, names) == sorted(expected, key=repr)
    spans = {r["doc_id"]: r["spans"] for r in found}
    text = dict(rows)[14]
    assert f"phone:{text.index('(942)'):d}:{text.index('(942)') + 14}" in spans[14]  # the field's


def test_base_spans_are_linear_and_leftmost():
    cases = [
        "a@b.c@d.e", "a@@b.c", "@b.c", "x.y@z", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "+1+2 (3) 4-5-6-7-8-9-0",
        "4111-1111 1111  1111", "00004111111111111111", "++49 30 901820 11", "a" * 50 + "@" * 50 + "b.c",
    ]
    for text in cases:
        assert sorted(pii_crf.base_spans(text)) == sorted(brute.pii_base(text)), text
    pii_crf.base_spans("1" * 300_000 + " @" + "a" * 300_000)  # ends


def test_field_learns_its_table_and_keeps_clean_text():
    field = pii_crf.fitted()
    wrong = 0
    for row in pii_crf.LABELLED:
        text, spans = pii_crf.parse(row)
        base, added = pii_crf.spans_of_texts([text], field)[0]
        wrong += sorted(base + added) != sorted(spans)
    assert wrong <= 1
    clean = ["In 2021 we sold 12,400 of 3.5 kg.", "§ 12 (3) 4-5, 1990-2000", brute.prose(3, 50)]
    assert all(base == added == [] for base, added in pii_crf.spans_of_texts(clean, field))


#: Rows that the field has not learned from, marked like its table.
HELD_OUT = [
    "Reach me on [phone|(212) 555-0198] today.",
    "My fax is [phone|303-555-0142].",
    "Tel 20, ask for [phone|617.555.0123].",
    "call [phone|020 7946 0321] now",
    "Tel. [phone|020 7946 0777]",
    "phone [phone|+44 20 7946 0958] please",
    "ueno [phone|415-555-2671] arst oien",
    "ring [phone|(415) 555 0132].",
    "Email [email|mary (at) firm (dot) org] soon.",
    "contact [email|peter [at] house [dot] net]",
    "Ask [email|anna at home dot org] please.",
    "to [email|BOB [AT] MAIL [DOT] COM] now",
    "write [email|kim at uni dot edu]",
    "mail [email|x.y@z.org], thanks",
    "the host [ip|10.20.30.40] is up",
    "card [card|4111-1111-1111-1111] ok",
    "SSN 219-09-9999 here",
    "born 12-05-1980, 42 kg",
    "ISBN 978-0-306-40615-7",
    "Look at this dot here.",
    "we met at 10 dot on the corner",
    "Sum 1,234,567.89 in 2020",
    "page 12-14, 2019-2020",
    "version 1.2.3 of 2021-01-05 10:00:00",
    "order 20210405-12 of 3 parts",
    "Meet (at) noon (dot) fine",
    "pi is 3.14159 and e 2.71828",
    "from 100 200 300 to 400",
    "He is at the red dot by 5.",
    "key abc123def456 and 0042",
    "page 123-456-7890",
    "order number 717-555-0202",
]


def test_field_on_held_out_rows():
    field, found, wrong, missed = pii_crf.fitted(), 0, 0, 0
    for row in HELD_OUT:
        text, spans = pii_crf.parse(row)
        base, added = pii_crf.spans_of_texts([text], field)[0]
        got, wanted = {*base, *added}, {*spans}
        found, wrong, missed = found + len(got & wanted), wrong + len(got - wanted), missed + len(wanted - got)
    assert (found, wrong, missed) == (16, 0, 0)


def test_spelt_out_addresses_reach_the_field_in_a_column(spark):
    texts = ["jane [AT] example [DOT] com", "write to tom at shop dot org please", "a clean text", None, "at dot at", "x" * 100_000 + " dot"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii_crf.find(docs, pii_crf.fitted()).collect()}
    assert found == {0: "email:0:27", 1: "email:9:28", 2: "", 3: "", 4: "", 5: ""}


def test_viterbi_is_the_best_path():
    field = pii_crf.fitted()
    chain = pii_crf._windows([pii_crf._shape(t) for t in ["a", " ", "(", "555", ")"]])
    n = len(pii_crf.LABELS)
    best = max(
        np.ndindex(*[n] * len(chain)),
        key=lambda path: (
            -1e9 * pii_crf.LABELS[path[0]].startswith("I")
            + sum(field.emission(w)[y] for w, y in zip(chain, path))
            + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
        ),
    )
    longer = pii_crf._windows([pii_crf._shape(t) for t in "call 555 - 1212 now please".split()])
    got = field.decode([longer, chain, []])
    assert got[1].tolist() == list(best) and len(got[0]) == len(longer) and len(got[2]) == 0


def test_redaction_changes_text_and_length(spark):
    docs = spark.createDataFrame(
        [(1, "to a@b.cd now", 13), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long"
    )
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii_crf.redacted(docs, pii_crf.fitted()).collect()}
    assert found == {1: ("to <EMAIL> now", 14), 2: ("clean", 5), 3: (None, None)}
    assert pii_crf.redact("0123456789", [("ip", 2, 5), ("card", 3, 7)]) == "01<IP>789"


# --- decontamination ---


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_of_awkward_texts(spark, edge, block_bytes):
    rows, docs = edge
    long = dict(rows)[10]
    items = [
        (1, long[300:500]), (2, long[400:700]), (2, long[400:700]), (3, "One!"), (4, None), (5, "..."), (None, "double blanks"),
        (10, "the of"), (6, brute.prose(7, 120)[:200]),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.report(docs, benchmark, block_bytes=block_bytes).collect()
    expected = [
        (doc_id, n, hit, len(ids), brute.sha(",".join(ids)), hit > 0)
        for (doc_id, _), (n, hit, ids) in zip(rows, brute.contamination(rows, items))
    ]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert by_id(found, names) == sorted(expected, key=repr)
    kept = decontaminate.remove(docs, benchmark)
    clean = [row for row, e in zip(rows, expected) if not e[-1]]
    assert kept.columns == docs.columns
    assert by_id(kept.collect(), ["doc_id", "text", "decontamination", "hits"]) == sorted([(*row, 7, 7) for row in clean], key=repr)
    cleaned = decontaminate.remove_spans(docs.select("doc_id", "text"), benchmark).collect()
    again = brute.contamination([(r["doc_id"], r["text"]) for r in cleaned], items)
    assert sum(n for n, *_ in again) == sum(e[1] - e[2] for e in expected)


def test_a_benchmark_of_many_blocks_holds_one_at_a_time(spark, monkeypatch):
    """Items of all sizes, one of them long, copies of an item, and a word that half of all words are."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 3000, 40)) for _ in range(300)]
    long = " ".join(f"v{k}" for k in range(4000))
    items = [*enumerate(texts[:100]), *[(7, texts[7])] * 50, (500, long), (501, "the"), (502, "the"), (503, "long " * 3)]
    docs = [*enumerate(texts), (900, "the x " * 3000), (901, " ".join(f"v{k}" for k in range(700, 730))), (902, "v1 v0 long long")]
    docs = [(i, t + (" " + " ".join(texts[3].split()[5:16]) if i == 200 else "")) for i, t in docs]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    sizes, made = [], decontaminate.window_set
    monkeypatch.setattr(decontaminate, "window_set", lambda *a: sizes.append((w := made(*a)).nbytes()) or w)
    found = decontaminate.report(table, benchmark, block_bytes=10_000).collect()
    assert len(sizes) > 4 and max(sizes) < (1 << decontaminate._TABLE_BITS) * 2 + 60 * 20_000
    expected = brute.contamination(docs, items)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"]
    assert by_id(found, names) == sorted(
        ((i, n, hit, len(ids), brute.sha(",".join(ids))) for (i, _), (n, hit, ids) in zip(docs, expected)), key=repr
    )
    hit = {r["doc_id"]: r["n_hit"] for r in found if r["n_hit"]}
    assert hit[900] == 3000 and hit[901] == 30 and hit[200] == 11 and 902 not in hit


def test_windows_that_share_a_hash_are_kept_apart(monkeypatch):
    monkeypatch.setattr(decontaminate, "_windows", lambda h, n: np.full(len(h) - n + 1, 7, np.uint64))
    windows = decontaminate.window_set([(1, "a b c"), (2, "a b d"), (3, "A b c"), (None, "d d"), (4, "x y")], 2)
    data = np.frombuffer(b"q a b d d" + bytes(8), np.uint8)
    n_words, _, hit, items = decontaminate._hits(data, np.array([0, 9]), windows)
    assert n_words.tolist() == [5] and hit.tolist() == [False, True, True, True, True]
    assert items == {0: {"1", "2", "3"}}


def test_decontamination_of_empty_tables(spark, edge, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(no_docs, none).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.report(edge[1], none).collect())


# --- quality rules ---


def test_quality_base_of_awkward_texts(edge):
    rows, docs = edge
    found = quality_rules.judge(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = [(i, *(brute.quality_base(t)[n] for n in names)) for i, t in rows]
    assert by_id(found, ["doc_id", *names]) == sorted(expected, key=repr)
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_quality_of_an_empty_table(no_docs):
    assert quality_rules.judge(no_docs).count() == 0


def test_posterior_follows_the_labels(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    judged = quality_rules.judge(docs).select("doc_id", "kept", "base_failed")
    rows = judged.join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.9 * len(rows)  # 200 documents to learn from


def test_estimation_finds_the_accuracies(spark):
    rng = np.random.default_rng(0)
    good = rng.random(20000) < 0.8
    right = [0.95, 0.9, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(20000) < r, good, ~good) * 2 - 1 for r in right], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    counts = collections.Counter(map(tuple, votes.tolist()))
    patterns = spark.createDataFrame([(list(k), n) for k, n in counts.items()], "votes array<tinyint>, n long")
    prior, chances = quality_rules.estimate(patterns, 4, rounds=60)
    assert abs(prior - 0.8) < 0.03
    for r, chance in zip(right, chances):
        assert abs(chance["good"][2] - 0.8 * r) < 0.03 and abs(chance["bad"][0] - 0.8 * r) < 0.08


# --- packing ---


def test_packing_of_awkward_texts(edge):
    from tokenizers import Tokenizer

    rows, docs = edge
    found = packing.pack_documents(docs, tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = collections.Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for k, (start, length) in enumerate(packing.cut(len(ids))):
            part = ids[start : start + length]
            expected[doc_id, k, start, length, zlib.crc32(struct.pack(f"<{length}I", *part))] += 1
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert collections.Counter(tuple(r[n] for n in names) for r in found) == expected
    filled = collections.defaultdict(list)
    for r in found:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(filled) <= -(-sum(r["length"] for r in found) // 1024) * 1.2 + 1


def test_chunks_give_the_tokens_of_the_whole():
    from tokenizers import Tokenizer

    chunks, tokenizer = packing.ChunkTokenizer(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    blanks = [" ", "  ", "\n", "\t ", "\u00a0", " \u00a0", "\u2003 ", "\u3000", "\x85", " \x85 ", "\x1c "]
    words = ["it's", "été", "A1b2", "...", "日本", "'s", "<|endoftext|>", "x", "\U0001f600"]
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(words) + rng.choice(blanks) for _ in range(40)) for _ in range(200)]
    for _, _, data, offsets in batches.text_groups(pa.array(texts), 5000):
        ids, sizes = chunks.encode(data, offsets)
        raw, cuts = data.tobytes(), np.concatenate(([0], np.cumsum(sizes)))
        for k in range(len(sizes)):
            text = raw[offsets[k] : offsets[k + 1]].decode()
            assert ids[cuts[k] : cuts[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # 7 closes for 8
    assert bins.put(3) == (0, 6)
    assert bins.put(2) == (2, 8)
    assert bins.put(10) == (3, 0) and bins.put(1) == (0, 9)
    assert packing.cut(2048) == [(0, 1024), (1024, 1024)] and packing.cut(1030) == [(0, 6), (6, 1024)]


def test_a_full_piece_closes_no_bin():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 10, 10)] == [(0, 0), (1, 0), (2, 0), (3, 0)]
    assert [bins.put(n) for n in (3, 4)] == [(1, 7), (0, 6)]  # both are still open


def test_sequences_hold_the_tokens(spark):
    docs = spark.createDataFrame([(k, brute.prose(k, 300 + k)) for k in range(12)], "doc_id long, text string")
    packed = packing.pack_documents(docs, tokenizer_path())
    made = packing.sequences(docs, packed, tokenizer_path()).collect()
    assert all(0 < len(r["ids"]) <= 1024 for r in made)
    total = packing.tokenized(docs, tokenizer_path()).collect()
    assert sum(len(r["ids"]) for r in made) == sum(len(r["ids"]) for r in total)


def test_packing_of_an_empty_table(no_docs):
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


@pytest.mark.parametrize("digits", [5_000, 300_000])
def test_addresses_with_very_many_digits(digits):
    for place in range(4):
        for long, found in (("0" * digits + "1", True), ("9" * digits, False), ("0" * digits, True)):
            parts = ["1", "2", "3", "4"]
            parts[place] = long
            text = "from " + ".".join(parts) + " on"
            spans = [s for s in pii_crf.base_spans(text) if s[0] == "ip"]
            assert spans == ([("ip", 5, len(text) - 3)] if found else [])


def test_a_very_long_run_of_digits_in_a_column(spark):
    texts = ["0" * 5000 + "1.1.1.1", "1." + "7" * 6000 + ".1.1", "write to a@b.cd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_ip"], r["n_email"]) for r in pii_crf.find(df, pii_crf.fitted()).collect()}
    assert found == {0: (1, 0), 1: (0, 0), 2: (0, 1)}


def test_chunks_are_kept_for_one_task(monkeypatch):
    """Nothing of the texts stays in the process once the task's tokenizer goes."""
    import gc
    import weakref

    made = packing.ChunkTokenizer(tokenizer_path())
    data = np.frombuffer(b"one two three one two" + bytes(8), np.uint8)
    ids, _ = made.encode(data, np.array([0, 21]))
    assert ids.tolist() == made.tokenizer.encode("one two three one two", add_special_tokens=False).ids
    gone = weakref.ref(made.slots)
    del made
    gc.collect()
    assert gone() is None
