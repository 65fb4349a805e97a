"""Personal data by fixed patterns and a linear-chain conditional random field over word shapes.

The patterns give the base spans: e-mail addresses, IP addresses, payment cards and phone numbers.
The field, trained from a small labelled table, adds spans that the patterns do not cover, such as
phone numbers without a country code and spelt-out e-mail addresses. It labels runs of letters,
runs of digits and single other characters by their shapes and their neighbours' shapes. Only
words with a digit, an at sign or a spelt-out one, and the words next to them, may carry a label, so
a text falls into short segments that are decoded in numpy batches.
What the field finds must still hold as many digits, or a valid address, as its kind demands.

Offsets count code points; an end is exclusive. Defined results: a null or empty text has no spans;
repeated rows get the same spans; an empty table has no rows; other columns are passed over by
``find`` and kept by ``redacted``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.batches import text_groups

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, and takes runs whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Spelt-out signs: in brackets, or "at" and "dot" as words about another one.
_SPELT = r"[\[({](?:at|dot)[\])}]|\bat(?=\s+[a-z0-9-]+\s+dot\s)|\bdot\b"
_CUE = re.compile(rf"[0-9@]|(?i:{_SPELT})", re.ASCII)
_SPELT_BYTES = re.compile(_SPELT.encode(), re.IGNORECASE)
_ENDINGS = {"com", "org", "net", "edu", "gov", "info"}
#: Words before numbers that are no telephone numbers.
_NUMBERED = {"page", "order", "ssn", "isbn", "serial", "lot", "invoice", "part", "item", "licence", "version"}
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"[0-9]+|\s|[^\W\d_]+|.", re.DOTALL)

Span = tuple[str, int, int]

#: A small labelled table: [kind|text] marks a span.
LABELLED = [
    "Call me at [phone|(942) 555-3625] or write a note.",
    "Our office: [phone|717-555-0202], open from 9 to 5.",
    "Ring [phone|(609) 555 7932] before 10 am on Monday.",
    "Phone [phone|020 7946 0958] and ask for room 12.",
    "Tel. [phone|555-555-0138] in the year 2019.",
    "Fax [phone|(864) 555-0138], page 3 of 7.",
    "The number is [phone|942.555.3625] in case of need.",
    "Dial [phone|+1 (309) 555-4006] today.",
    "please ring [phone|333-555-1212].",
    "or [phone|303-555-0199], she said.",
    "Dial [phone|+49 30 901820] at night, not 110.",
    "You can reach us on [phone|212 555 0147] until 18:30.",
    "in ored [phone|+1 (394) 555-4006] enst ontheaea",
    "Write to [email|jane.doe@example.com] for 2 copies.",
    "Mail [email|info@mail4.example.org], subject 42.",
    "Send it to [email|jane (at) example (dot) com] please.",
    "Send it to [email|bob [at] example [dot] org] please.",
    "Reach [email|sales (at) shop (dot) net] by noon.",
    "Write to [email|jane at example dot com] for details.",
    "Please ask [email|tom at shop dot org] about it.",
    "[email|mia at school dot edu]",
    "[email|ben at office dot net] or call at noon.",
    "mail [email|eve at club dot org], she said",
    "or [email|max at work dot info]",
    "Send it to [email|JANE [AT] EXAMPLE [DOT] COM] please.",
    "Mail [email|ANNA (AT) SITE (DOT) ORG] today.",
    "[email|Tom [AT] Shop [DOT] Net] is mine.",
    "Look at the dot on the map.",
    "They stop at every dot in the picture.",
    "a dot and a line at noon",
    "Tel [phone|020 7946 0958] or write.",
    "SSN 123-45-6789 is on the form.",
    "See page 312-555-0176 of it.",
    "Order 800-555-0143 was sent, lot 212-555-0191 was not.",
    "from 300 400 500 to 900 of them",
    "His number 078-05-1120 was on the card.",
    "[email|oning.10@mail8.example.com] are the inor",
    "We met (at) the station at 8.",
    "They are [at] home with 3 dogs.",
    "See you (at) lunch, table 4.",
    "Host [ip|136.7.148.71] answered in 12 ms.",
    "The server [ip|10.0.0.1] is down since 14:05.",
    "Ping [ip|192.168.1.254], port 8080.",
    "hereon [ip|97.51.17.173] the er anonat",
    "Paid by [card|4111 1111 1111 1111] on the 3rd.",
    "Card [card|5500-0000-0000-0004] was declined twice.",
    "storor [card|4012888888881881] thhaoron.",
    "Charge [card|378282246310005], 19.99 in all.",
    "Released under version 2.0 of the licence.",
    "Licensed under CC BY-NC 4.0.",
    "Version 10.2.1 came out on 2021-03-04 at 12:30:15.",
    "In 1999 and 2001 there were 1,234,567 of them.",
    "The price is 1 234.50 and rises by 3.5 percent.",
    "token = \"0401e44b4045d5b7fc925af2d5b1396433e9ee50\" der",
    "key 9f8e7d6c5b4a and id 1234567890123 were made up.",
    "Chapter 12, section 3.4.5, lines 100-250.",
    "ISBN 978-3-16-148410-0 is a book of 320 pages.",
    "Order 20230104-77 has 15 parts, see page 1/2.",
    "It was 3-2 after 90 minutes in front of 45000.",
    "Room 101, floor 7, from 08:15 to 17:45.",
    "The score was 21-19 21-17 on 12.05.2020.",
    "About 60 000 people, 12 % more than in 2010.",
    "no digits here, only words and a dash - or two",
    "Serial 004-123-889-120-55 and lot 77-12.",
    "A list: 1. one 2. two 3. three 4. four.",
    "mail was sent at noon on the 5th",
    "follow @someone and @other42 there",
    "x = 3.14159265 + 2.71828 * 10",
]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; those that fail the kind's check are dropped."""
    out: list[Span] = []
    at = text.find("@")
    done = 0
    while at >= 0:
        local = text[done:at]
        start = done + len(local.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append(("email", start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]  # int() refuses very many digits
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def _shape(token: str) -> str:
    if token.isascii() and token.isdigit():
        n = len(token)
        return f"d{n}" if n < 5 else "d5-8" if n < 9 else "d9-12" if n < 13 else "d13-19" if n < 20 else "d20"
    if token.isspace():
        return " "
    if token.isalpha():
        if token.lower() in ("at", "dot"):
            return token.lower()
        if token.lower() in _ENDINGS:
            return "tld"
        if token.lower() in _NUMBERED:
            return "no"
        return "a1" if len(token) == 1 else "A" if token[0].isupper() else "a"
    return token if token.isascii() else "u"


def _features(window: tuple[str, ...]) -> list[str]:
    """Of a token's shape and the three on either side."""
    a, b, c, x, d, e, f = window
    return [
        "1", f"0{x}", f"-{c}", f"+{d}", f"--{b}", f"++{e}", f"---{a}", f"+++{f}", f"-0{c}|{x}",
        f"0+{x}|{d}", f"-0+{c}|{x}|{d}", f"--0{b}|{c}|{x}", f"0++{x}|{d}|{e}",
    ]


def _windows(shapes: list[str]) -> list[tuple[str, ...]]:
    padded = ["^", "^", "^", *shapes, "$", "$", "$"]
    return [tuple(padded[k : k + 7]) for k in range(len(shapes))]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """A linear-chain conditional random field over token windows."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, steps: np.ndarray) -> None:
        self.names, self.weights, self.steps = names, weights, steps
        self.known: dict[tuple[str, ...], np.ndarray] = {}

    def emission(self, window: tuple[str, ...]) -> np.ndarray:
        row = self.known.get(window)
        if row is None:
            at = [self.names[f] for f in _features(window) if f in self.names]
            row = self.weights[at].sum(axis=0)
            if len(self.known) < 100_000:
                self.known[window] = row
        return row

    def decode(self, chains: list[list[tuple[str, ...]]]) -> list[np.ndarray]:
        """The likeliest labels of each chain, all chains step by step together."""
        order = sorted(range(len(chains)), key=lambda k: -len(chains[k]))
        sizes = np.array([len(chains[k]) for k in order])
        if not sizes.sum():
            return [np.zeros(0, np.int64) for _ in chains]
        firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        scores = np.array([self.emission(w) for k in order for w in chains[k]])
        back = np.zeros(scores.shape, np.int8)
        start = np.where([x[0] == "I" for x in LABELS], -1e9, 0.0)
        active = int((sizes > 0).sum())
        best = scores[firsts[:active]] + start
        final = np.zeros(len(order), np.int64)
        for t in range(1, int(sizes[0]) + 1):
            now = int(np.searchsorted(-sizes, -t, "left"))  # chains longer than t
            final[now:active] = best[now:active].argmax(axis=1)
            if not now:
                break
            both = best[:now, :, None] + self.steps
            back[firsts[:now] + t] = both.argmax(axis=1)
            best[:now] = both.max(axis=1) + scores[firsts[:now] + t]
            active = now
        labels = np.zeros(len(scores), np.int64)
        state = final.copy()
        for t in range(int(sizes[0]) - 1, -1, -1):
            now = int(np.searchsorted(-sizes, -t, "left"))
            labels[firsts[:now] + t] = state[:now]
            if t:
                state[:now] = back[firsts[:now] + t, state[:now]]
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(chains)
        for k, first, size in zip(order, firsts, sizes):
            out[k] = labels[first : first + size]
        return out


def parse(marked: str) -> tuple[str, list[Span]]:
    """A row of the labelled table: (text, spans)."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\[(email|ip|card|phone)\|((?:[^\[\]]|\[\w+\])+)\]", marked):
        text += marked[at : m.start()]
        spans.append((m.group(1), len(text), len(text) + len(m.group(2))))
        text += m.group(2)
        at = m.end()
    return text + marked[at:], spans


def train(table: list[tuple[str, list[Span]]], rounds: int = 120, penalty: float = 0.02) -> Field:
    """Maximises the penalised conditional likelihood of a small labelled table (text, spans)."""
    chains, truths = [], []
    names: dict[str, int] = {}
    for text, spans in table:
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        chain = _windows([_shape(text[a:b]) for a, b in tokens])
        truth = np.zeros(len(tokens), np.int64)
        for kind, low, high in spans:
            inside = [k for k, (a, b) in enumerate(tokens) if a >= low and b <= high]
            truth[inside] = LABELS.index(f"I-{kind}")
            truth[inside[0]] = LABELS.index(f"B-{kind}")
        chains.append([[names.setdefault(f, len(names)) for f in _features(w)] for w in chain])
        truths.append(truth)
    s, t, n = len(chains), max(map(len, chains)), len(LABELS)
    width = len(_features(("",) * 7))
    features = np.full((s, t, width), len(names))
    mask = np.zeros((s, t), bool)
    truth = np.zeros((s, t), np.int64)
    for k, (chain, y) in enumerate(zip(chains, truths)):
        features[k, : len(chain)], mask[k, : len(chain)], truth[k, : len(chain)] = chain, True, y
    start = np.where([x[0] == "I" for x in LABELS], -1e9, 0.0)
    banned = np.array([[y[0] == "I" and x[1:] != y[1:] for y in LABELS] for x in LABELS])
    weights, steps = np.zeros((len(names) + 1, n)), np.where(banned, -1e9, 0.0)
    squares_w, squares_s = np.full(weights.shape, 1e-8), np.full(steps.shape, 1e-8)
    pairs = mask[:, 1:]
    seen_steps = np.zeros((n, n))
    np.add.at(seen_steps, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
    wanted = np.eye(n)[truth] * mask[..., None]
    for _ in range(rounds):
        e = weights[features].sum(axis=2)
        alpha, beta = np.empty((t, s, n)), np.zeros((t, s, n))
        alpha[0] = e[:, 0] + start
        for k in range(1, t):
            step = _log_sum(alpha[k - 1][:, :, None] + steps, 1) + e[:, k]
            alpha[k] = np.where(mask[:, k, None], step, alpha[k - 1])
        for k in range(t - 2, -1, -1):
            step = _log_sum(steps + (e[:, k + 1] + beta[k + 1])[:, None, :], 2)
            beta[k] = np.where(mask[:, k + 1, None], step, beta[k + 1])
        total = _log_sum(alpha[-1], 1)
        node = np.exp(alpha.transpose(1, 0, 2) + beta.transpose(1, 0, 2) - total[:, None, None]) * mask[..., None]
        edge = np.exp(
            alpha.transpose(1, 0, 2)[:, :-1, :, None] + steps
            + (e[:, 1:] + beta.transpose(1, 0, 2)[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        grad_s = seen_steps - (edge * pairs[..., None, None]).sum(axis=(0, 1)) - penalty * np.where(banned, 0, steps)
        grad_w = np.zeros_like(weights)
        np.add.at(grad_w, features.ravel(), np.repeat((wanted - node).reshape(-1, n), width, axis=0))
        grad_w[-1] = 0
        grad_w -= penalty * weights
        grad_s[banned] = 0
        squares_w += grad_w**2
        squares_s += grad_s**2
        weights += 0.5 * grad_w / np.sqrt(squares_w)
        steps += 0.5 * grad_s / np.sqrt(squares_s)
    return Field(names, weights[:-1], steps)


@cache
def default_field() -> Field:
    return train([parse(row) for row in LABELLED])


def segments(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of words that have a cue or are next to a word with one."""
    low = high = -1
    at = 0
    while found := _CUE.search(text, at):
        start = _word_start(text, found.start(), at)
        end = _word_end(text, found.start())
        at = end
        if (left := _skip_back(text, start)) > 0:
            start = _word_start(text, left - 1, max(high, 0))
        end_right = end
        while end_right < len(text) and text[end_right].isspace():
            end_right += 1
        end = _word_end(text, end_right) if end_right < len(text) else len(text.rstrip()) if end_right > end else end
        if low >= 0 and start <= high:
            high = max(high, end)
        else:
            if low >= 0:
                yield low, high
            low, high = start, end
    if low >= 0:
        yield low, high


def _word_start(text: str, at: int, low: int) -> int:
    while at > low and not text[at - 1].isspace():
        at -= 1
    return at


def _skip_back(text: str, at: int) -> int:
    while at > 0 and text[at - 1].isspace():
        at -= 1
    return at


def _word_end(text: str, at: int) -> int:
    found = _SPACE.search(text, at)
    return found.start() if found else len(text)


def _valid(kind: str, text: str) -> bool:
    """The checks that a span of the field must pass."""
    if text != text.strip():
        return False
    digits = "".join(_DIGIT.findall(text))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts)
    return text[-1].isalnum() and bool(re.search(r"@|\Wat\W", text, re.I)) and bool(re.search(r"\.|\Wdot\W", text, re.I))


def spans_of_texts(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    bases = [base_spans(t) for t in texts]
    places, chains = [], []
    for k, t in enumerate(texts):
        for low, high in segments(t):
            tokens = [(low + m.start(), low + m.end()) for m in _TOKEN.finditer(t[low:high])]
            places.append((k, tokens))
            chains.append(_windows([_shape(t[a:b]) for a, b in tokens]))
    added: list[list[Span]] = [[] for _ in texts]
    for (k, tokens), labels in zip(places, field.decode(chains)):
        i = 0
        while i < len(tokens):
            if labels[i] and LABELS[labels[i]][0] == "B":
                kind, j = LABELS[labels[i]][2:], i + 1
                while j < len(tokens) and LABELS[labels[j]] == f"I-{kind}":
                    j += 1
                span = (kind, tokens[i][0], tokens[j - 1][1])
                if _valid(kind, texts[k][span[1] : span[2]]):
                    added[k].append(span)
                i = j
            else:
                i += 1
    for k, base in enumerate(bases):
        if added[k] and base:
            taken = sorted((a, b) for _, a, b in base)
            starts = np.array([a for a, _ in taken])
            ends = np.maximum.accumulate([b for _, b in taken])
            kept = []
            for span in added[k]:
                before = int(np.searchsorted(starts, span[2], "left"))
                if not before or ends[before - 1] <= span[1]:
                    kept.append(span)
            added[k] = kept
    return list(zip(bases, added))


def joined(spans: list[Span]) -> str:
    """kind:start:end by kind as listed, then start."""
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def _likely(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a digit or an at sign, or with a spelt-out one."""
    size = int(offsets[-1])
    part = data[:size]
    hit = np.flatnonzero((part == 0x40) | ((part >= 0x30) & (part <= 0x39)))
    rows = np.searchsorted(offsets, hit, "right") - 1
    spelt = np.array([m.start() for m in _SPELT_BYTES.finditer(part.tobytes())], np.int64)
    return np.unique(np.concatenate((rows, np.searchsorted(offsets, spelt, "right") - 1)))


def _all_spans(column: pa.Array, field: Field) -> dict[int, tuple[list[Span], list[Span]]]:
    found: dict[int, tuple[list[Span], list[Span]]] = {}
    for first, _, data, offsets in text_groups(column):
        rows = _likely(data, offsets).tolist()
        texts = [data[offsets[r] : offsets[r + 1]].tobytes().decode() for r in rows]
        for r, spans in zip(rows, spans_of_texts(texts, field)):
            found[first + r] = spans
    return found


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans and n_added."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _all_spans(batch.column(1), field)
            rows = [found.get(r, ([], [])) for r in range(batch.num_rows)]
            counts = [
                pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS
            ]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *counts,
                    pa.array(digests, pa.string()),
                    pa.array([joined(base + added) for base, added in rows], pa.string()),
                    pa.array([len(added) for _, added in rows], pa.int64()),
                ],
                ["doc_id", *names, "base_sha256", "spans", "n_added"],
            )

    schema = f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, base_sha256 string, spans string, n_added long"
    return docs.select(doc_id, text).mapInArrow(run, schema)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first one's kind."""
    out, at = [], 0
    for kind, low, high in sorted(spans, key=lambda s: (s[1], -s[2])):
        if low >= at:
            out += [text[at:low], f"<{kind.upper()}>"]
        at = max(at, high)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, field: Field, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with their spans replaced, and the length column, if there is one, set anew
    for the texts that changed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text)
            found = _all_spans(batch.column(k), field)
            changed = {r: base + added for r, (base, added) in found.items() if base or added}
            if changed:
                texts = batch.column(k).to_pylist()
                for r, spans in changed.items():
                    texts[r] = redact(texts[r], spans)
                batch = batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))
                n = batch.schema.get_field_index(length) if length else -1
                if n >= 0:
                    sizes = batch.column(n).to_pylist()
                    for r in changed:
                        sizes[r] = len(texts[r])
                    batch = batch.set_column(n, batch.schema.field(n), pa.array(sizes, batch.schema.field(n).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def fitted(table: list[tuple[str, list[Span]]] | None = None, **options: Any) -> Field:
    """The field of the built-in table, or of another one."""
    return default_field() if table is None else train(table, **options)
