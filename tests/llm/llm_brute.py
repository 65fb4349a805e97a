"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5


def prose(seed, words, alphabet="the of and stone river light walks under green seven ñandú été".split()):
    rng = random.Random(seed)
    made = [rng.choice(alphabet) if rng.random() < 0.5 else "".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randint(3, 9))) for _ in range(words)]
    return " ".join(w + rng.choice(["", "", "", ",", ".", ".\n"]) for w in made)


def edge_rows():
    """(doc_id, text) with every awkward case: nulls, empty and long texts, copies, repeated rows."""
    long = prose(1, 9000)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(5, 80)), (5, prose(5, 80)),
        (None, prose(6, 60)), (None, None), (7, prose(7, 120)), (8, prose(7, 120)), (9, prose(7, 119) + " changed"),
        (10, long), (11, long[:20000] + " cut here " + long[20300:40000]), (12, "Und " * 300), (13, "a" * 3000),
        (14, "Mail jane.doe@example.com or ring (942) 555-3625, not 10.0.0.1; card 4111 1111 1111 1111."),
        (15, "x@y.z +1 (942) 555-3625### 999.1.1.1 1.2.3.4.5.6.7.8 4111111111111112 " + prose(15, 60)),
        (16, "dit’s\u00a0now \u2003wide  double   blanks\u3000end é le ça <|endoftext|> it's 12,5% \r\n\r\n tail "),
        (17, "!!! ??? 123 ---"), (18, "日本語 の テキスト です " * 20), (19, "\x00null\x00 byte " + prose(19, 40)),
    ]
    return rows + [(100 + k, prose(200 + k, 20 + 9 * k)) for k in range(30)]


def pii_base(text):
    from riskloom.llm.pii_crf import luhn

    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    out = []
    for kind, pattern in patterns:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def contamination(rows, items, n=10):
    """(n_words, n_hit, item IDs) of each row."""
    words_of = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    windows = collections.defaultdict(set)
    for item, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[k : k + size])] |= set() if item is None else {str(item)}
    sizes = {len(w) for w in windows}
    out = []
    for _, text in rows:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(words[k : k + size])]
        out.append((len(words), len(hit), sorted(found)))
    return out


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = collections.Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def repeats(rows, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    texts = [(t or "").encode() for _, t in rows]
    counts = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone, end = bytearray(len(t)), 0
        for k in range(len(t) - length + 1):
            if counts[t[k : k + length]] > 1:
                gone[max(k, end) : k + length] = b"\x01" * (k + length - max(k, end))
                end = k + length
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text):
    import xxhash

    words = WORD.findall(low(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, bits):
    """The root (lowest place) of each value's component, by all pairs."""
    parent = list(range(len(values)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]
