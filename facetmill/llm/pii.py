"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

Words without a digit, ``@`` or ``+`` that are not part of a spelled-out email ("name at host dot com") are outside any span
by definition, so the field's chain falls apart into the runs of other words between them, and decoding these runs is
decoding the text. The field adds national phones, emails beyond ASCII or spelled out, cards in other separators, and IPv6 or
defanged addresses; its label decides, after a loose check that the span can be of its kind at all. Runs are decoded by Viterbi in numpy batches.
The field is trained on the driver from a small labelled table in under a second or two, and broadcast.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .names import apart
from .workers import Batches, bounded, map_batches

KINDS = ("email", "ip", "card", "phone")
#: Patterns fixed by the query's contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Parts of them, for search in linear time: what follows an ``@``, and all groups of digits with single dots between.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_GROUPS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")

LABELS = ("O", "B-EMAIL", "I-EMAIL", "IP", "B-CARD", "I-CARD", "B-PHONE", "I-PHONE")
GAPS = " \t\n\x0b\x0c\r"
_TRIGGER = re.compile(r"[0-9@+][^\x20\t-\r]*")
#: Emails spelled out: "at" and "dot" as words, in brackets or not, and in brackets inside a word.
_BRACKETED = re.compile(r"[(\[{<](?:at|dot)[)\]}>]", re.IGNORECASE)
_SPELLED = re.compile(
    r"(?<![^\x20\t-\r])(?:[^\x20\t-\r]++[\x20\t-\r]{1,8}[(\[{<]?at[)\]}>]?[\x20\t-\r]{1,8}[^\x20\t-\r]++|[^@\x20\t-\r]++@[^\x20\t-\r]++)"
    r"(?:[\x20\t-\r]{1,8}[(\[{<]?dot[)\]}>]?[\x20\t-\r]{1,8}[^\x20\t-\r]++)+", re.IGNORECASE,
)
_SAID = re.compile(r"\s*(?:[(\[{<](at|dot)[)\]}>]|(?<!\S)(at|dot)(?!\S))\s*", re.IGNORECASE)
_WORD = re.compile(r"[^\x20\t-\r]+")
#: An email in any script.
WIDE_EMAIL = re.compile(r"[\w.%+'-]+@[\w-]+(?:\.[\w-]+)*\.(?:[^\W\d_]{2,}|xn--[a-z0-9-]+)")
DOMAINS = {
    "com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "uk", "de", "fr", "es", "ch", "nl", "se", "pl", "eu", "ca", "au", "jp", "cn", "br", "ru", "dk", "fi", "pt",
}
_EDGE = ".,;:!?\"'()[]{}<>"
FEATURES = 1 << 12  # hashed
LABELLED_LINES = 900
ROUNDS = 160

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """The pattern's matches: whether one stands around an ``@`` depends on what follows it, and it begins as early as it can."""
    done, at = 0, text.find("@")
    while at >= 0:
        end = at + 1
        if m := _DOMAIN.match(text, at + 1):
            low = at
            while low > done and (c := text[low - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
                low -= 1
            if low < at:
                yield low, 0, m.end()
                done = end = m.end()
        at = text.find("@", end)


def _addresses(text: str) -> Iterator[Span]:
    """The pattern's matches with parts of at most 255: groups of digits are taken by fours, from the first of each chain."""
    for m in _GROUPS.finditer(text):
        groups, low = m.group().split("."), m.start()
        for i in range(0, len(groups) - 3, 4):
            four = groups[i:i + 4]
            high = low + sum(map(len, four)) + 3
            if all(len(p) < 4 and int(p or 0) <= 255 for p in (g.lstrip("0") for g in four)):
                yield low, 1, high
            low = high + 1


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass its check, by start and kind."""
    out = [*_emails(text), *_addresses(text)]
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Words of what may be an email spelled out, as (start, end), some of them twice."""
    if "dot" in text or "DOT" in text or "Dot" in text:
        for m in _SPELLED.finditer(text):
            yield from (w.span() for w in _WORD.finditer(text, *m.span()))
    done = 0
    for m in _BRACKETED.finditer(text):
        low, high = m.span()
        if low < done:
            continue  # in the word of the one before
        while low and text[low - 1] not in GAPS:
            low -= 1
        done = high = w.end() if (w := _WORD.match(text, high)) else high
        yield low, high
        if (low, high) == m.span():
            # A bracketed word of its own: the words beside it belong to it.
            if w := _WORD.search(text, high):
                yield w.span()
            end = low
            while end and text[end - 1] in GAPS:
                end -= 1
            start = end
            while start and text[start - 1] not in GAPS:
                start -= 1
            if start < end:
                yield start, end


def _words(text: str) -> Iterator[tuple[int, int]]:
    """Words that may be in a span, in order."""
    spelled = sorted(set(_spelled(text)))
    at = 0
    for m in _TRIGGER.finditer(text):
        low = m.start()
        while low and text[low - 1] not in GAPS:
            low -= 1
        while at < len(spelled) and spelled[at][0] <= low:
            if spelled[at][0] < low:
                yield spelled[at]
            at += 1
        yield low, m.end()
    yield from spelled[at:]


def runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Neighbouring words that hold a digit, ``@`` or ``+`` or are part of an email spelled out, as (start, end)."""
    run: list[tuple[int, int]] = []
    for low, high in _words(text):
        if run and not (0 < low - run[-1][1] <= 8 and not text[run[-1][1]:low].strip(GAPS)):
            yield run
            run = []
        run.append((low, high))
    if run:
        yield run


def shape(word: str) -> str:
    """Digits as 9, letters as a or A, equal neighbours folded; lengths of the digit groups stay, up to 4."""
    out = []
    for m in re.finditer(r"[0-9]+|[a-z]+|[A-Z]+|.", word, re.DOTALL):
        c, n = m.group()[0], len(m.group())
        out.append("9" * min(n, 4) if "0" <= c <= "9" else "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "x" if c.isalnum() else c)
    return "".join(out)


def _sign(said: re.Match) -> str:
    return "@" if "at" in said.group().lower() else "."


def features(word: str) -> list[int]:
    """Hashed word-shape features."""
    core = word.strip(_EDGE)
    digits = _digits(core)
    parts = core.split(".")
    names = [
        "1", "s:" + shape(word), "c:" + shape(core), f"d{min(len(digits), 20)}", f"l{min(len(word), 24) // 3}", "f" + shape(word[:1]),
        "e" + shape(word[-1:]), f"dots{min(core.count('.'), 4)}", f"at{core.count('@') == 1 and 0 < core.find('@') < len(core) - 1}",
        f"plus{core[:1] == '+'}", f"paren{'(' in word}", f"alpha{any(c.isalpha() for c in core)}",
        f"luhn{14 <= len(digits) <= 19 and luhn(digits)}", f"ip{len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"only{not core.strip('0123456789-')}", f"all{digits == core}{min(len(digits), 8)}",
        f"said{core.lower() if core.lower() in ('at', 'dot') else ''}{bool(_BRACKETED.search(word))}", f"domain{core.lower() in DOMAINS}",
        f"wide{not word.isascii()}{bool(WIDE_EMAIL.fullmatch(_SAID.sub(_sign, core)))}", f"colons{min(core.count(':'), 8)}{'::' in core}",
    ]
    return [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=4).digest(), "little") % FEATURES for n in names]


@dataclass
class Field:
    """Weights of features by label, of label pairs, and of first and last labels."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def scores(self, words: Iterable[list[int]]) -> np.ndarray:
        return np.array([self.emit[w].sum(axis=0) for w in words])

    def decode(self, sequences: list[list[list[int]]]) -> list[np.ndarray]:
        """The best labels of each sequence. Sequences of like length are decoded together."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        low = 0
        while low < len(order):
            high = low + 1
            while high < len(order) and high - low < 4096 and len(sequences[order[high]]) <= 2 * len(sequences[order[low]]):
                high += 1
            self._viterbi([sequences[i] for i in order[low:high]], order[low:high], out)
            low = high
        return out

    def _viterbi(self, sequences, places, out) -> None:
        lengths = np.array([len(s) for s in sequences])
        longest, n, labels = lengths.max(), len(sequences), len(LABELS)
        emit = np.zeros((n, longest, labels))
        for i, s in enumerate(sequences):
            emit[i, : len(s)] = self.scores(s)
        best = emit[:, 0] + self.first
        back = np.zeros((n, longest, labels), np.int8)
        for t in range(1, longest):
            total = best[:, :, None] + self.move
            back[:, t] = total.argmax(axis=1)
            step = total.max(axis=1) + emit[:, t]
            best = np.where((t < lengths)[:, None], step, best)
        label = (best + self.last).argmax(axis=1)
        paths = np.zeros((n, longest), int)
        for t in range(longest - 1, -1, -1):
            here = t < lengths
            paths[here, t] = label[here]
            if t:
                label = np.where(here, back[np.arange(n), t, label], label)
        for i, place in enumerate(places):
            out[place] = paths[i, : lengths[i]]


def train(table: list[tuple[list[str], list[str]]], rounds: int = ROUNDS, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a small penalty, by full-batch Adam; gradients from forward and backward sums."""
    labels, n = len(LABELS), len(table)
    longest = max(len(w) for w, _ in table)
    lengths = np.array([len(w) for w, _ in table])
    where = [(i, t, features(word)) for i, (words, _) in enumerate(table) for t, word in enumerate(words)]
    rows, at = np.array([(i, t) for i, t, _ in where]).T
    ids = np.array([f for _, _, f in where])
    gold = np.zeros((n, longest, labels))
    for i, (_, tags) in enumerate(table):
        gold[i, np.arange(len(tags)), [LABELS.index(x) for x in tags]] = 1
    mask = (np.arange(longest) < lengths[:, None])[:, :, None]
    shapes = [(FEATURES, labels), (labels, labels), (labels,), (labels,)]
    weights = [np.zeros(s) for s in shapes]
    means, squares = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    end = lengths - 1

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    gold_moves = np.einsum("ntj,ntk->jk", gold[:, :-1], gold[:, 1:])
    for round_ in range(1, rounds + 1):
        emit_w, move, first, last = weights
        emit = np.zeros((n, longest, labels))
        emit[rows, at] = emit_w[ids].sum(axis=1)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = log_sum(forward[:, t - 1, :, None] + move, 1) + emit[:, t]
        for t in range(longest - 1, -1, -1):
            later = log_sum(move + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2) if t + 1 < longest else 0
            backward[:, t] = np.where((t >= end)[:, None], last, later)
        whole = log_sum(forward[np.arange(n), end] + last, 1)
        chance = np.exp(np.minimum(0, forward + backward - whole[:, None, None])) * mask
        grad_emit = np.zeros(shapes[0])
        np.add.at(grad_emit, ids.ravel(), np.repeat((gold - chance)[rows, at], ids.shape[1], axis=0))
        pair = forward[:, :-1, :, None] + move + (emit + backward)[:, 1:, None, :] - whole[:, None, None, None]
        inside = (np.arange(1, longest) < lengths[:, None])[:, :, None, None]
        grad_move = gold_moves - (np.exp(np.minimum(0, pair)) * inside).sum(axis=(0, 1))
        tail = np.arange(n), end
        grads = [grad_emit, grad_move, (gold - chance)[:, 0].sum(axis=0), (gold - chance)[tail].sum(axis=0)]
        for i, g in enumerate(grads):
            g = g / n - ridge * weights[i]
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            weights[i] = weights[i] + 0.1 * (means[i] / (1 - 0.9**round_)) / (np.sqrt(squares[i] / (1 - 0.99**round_)) + 1e-8)
    return Field(*weights)


def labelled_table(lines: int = LABELLED_LINES, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: runs of words and their labels, written by rule from common formats and their look-alikes."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(n))

    def card() -> list[tuple[str, str]]:
        body = rng.choice("3456") + digits(rng.choice([13, 14, 14, 14, 14, 15]))
        full = body + next(c for c in "0123456789" if luhn(body + c))
        form = rng.randrange(5)
        if form < 2:
            return [(full, "B-CARD")]
        parts = [full[i:i + 4] for i in range(0, len(full), 4)]
        if form == 2:
            return [("-".join(parts), "B-CARD")]
        if form == 3:
            return [(rng.choice("./_\u2013\xa0").join(parts), "B-CARD")]
        return [(p, "I-CARD" if i else "B-CARD") for i, p in enumerate(parts)]

    def phone() -> list[tuple[str, str]]:
        code, area, rest = f"+{rng.randint(1, 99)}", digits(3), f"{digits(3)}-{digits(4)}"
        words = rng.choice([
            [code, f"({area})", rest], [code, f"({area})", rest], [code, area, rest], [f"{code}-{area}-{rest}"], [code + digits(10)],
            [code, area, digits(3), digits(4)], [f"{code}.{area}.{digits(3)}.{digits(4)}"], [f"{code}({area}){rest}"], [f"({area})", rest],
            [f"{area}-{rest}"], [f"{area}-{rest}"], [f"{area}.{digits(3)}.{digits(4)}"], [f"{area}.{digits(3)}.{digits(4)}"], [f"1-{area}-{rest}"], [f"({area}){rest}"],
            [f"0{digits(2)}/{digits(8)}"], [f"0{digits(3)}/{digits(7)}"], [f"0{digits(3)}-{digits(7)}"],
        ])
        return [(w, "I-PHONE" if i else "B-PHONE") for i, w in enumerate(words)]

    def email() -> list[tuple[str, str]]:
        name = letters(rng.randint(2, 9)) + rng.choice(["", "." + digits(2), "_" + letters(4), "+" + letters(3), "-" + digits(3)])
        host = f"{letters(rng.randint(3, 8))}{rng.choice(['', digits(1)])}"
        domain = rng.choice(["example.com", "com", "org", "co.uk", "de"])
        form = rng.randrange(12)
        if form < 4:
            return [(f"{name}@{host}.{domain}", "B-EMAIL")]
        if form < 6:
            odd = lambda w: w[:1] + rng.choice("äöüéèñçøåßłжд漢") + w[1:]
            return [(f"{odd(name) if form == 4 else name}@{odd(host)}.{domain}", "B-EMAIL")]
        left, right = rng.choice([("", ""), ("(", ")"), ("[", "]"), ("{", "}")])
        at, dot = rng.choice([("at", "dot"), ("at", "dot"), ("AT", "DOT")])
        if form < 8 and left:
            inner = f"{left}{dot}{right}" if rng.random() < 0.5 else "."
            return [(f"{name}{left}{at}{right}{host}{inner}{domain}", "B-EMAIL")]
        words = [name, f"{left}{at}{right}", host] if rng.random() < 0.8 else [f"{name}@{host}"]
        if left and len(words) == 3 and rng.random() < 0.3:
            words[-1] = f"{host}.{domain}"
        else:
            words += [w for part in domain.split(".") for w in (f"{left}{dot}{right}", part)]
        words[-1] += rng.choice(["", "", ",", "."])
        return [(w, "I-EMAIL" if i else "B-EMAIL") for i, w in enumerate(words)]

    def ip() -> list[tuple[str, str]]:
        groups = [f"{rng.randint(0, 65535):x}" for _ in range(8)]
        form = rng.randrange(6)
        if form == 3:
            return [(":".join(groups), "IP")]
        if form == 4:
            low = rng.randint(1, 4)
            return [(":".join(groups[:low]) + "::" + ":".join(groups[:rng.randint(1, 3)]), "IP")]
        return [(("[.]" if form == 5 else ".").join(str(rng.randint(0, 255)) for _ in range(4)), "IP")]

    def other() -> list[tuple[str, str]]:
        words = rng.choice([
            [str(rng.randint(0, 99999))], [f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"], [f"{digits(2)}:{digits(2)}"],
            [f"{rng.randint(1, 20)}.{digits(1)}.{digits(1)}"], [f"${digits(3)}.{digits(2)}"], [letters(3) + digits(2) + letters(2)], [digits(8) + letters(4) + digits(12)],
            [f"{letters(5)}={digits(6)}{letters(4)}"], ["A" + digits(4) + "B" + digits(3)], [f"{rng.randint(1, 9)}."], [f"@{letters(6)}"], ["+"], [f"{digits(2)}%"],
            [f"({digits(1)})"], [f"{digits(3)}", f"{digits(3)}"], [f"{rng.randint(300, 999)}.{digits(3)}.{rng.randint(300, 999)}.{digits(3)}"], [digits(12)], [f"+{digits(1)}"],
            [f"{digits(4)}-{digits(4)}"], [f"C++{digits(2)}"], [f"{digits(16)}{letters(2)}"],
            # Look-alikes of phones, addresses and emails spelled out.
            [f"{digits(3)}-{digits(2)}-{digits(4)}"], [f"{digits(3)}-{digits(3)}-{digits(3)}"], [f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}"],
            [f"{digits(5)}-{digits(4)}"], [f"{digits(3)}.{digits(3)}.{digits(3)}"], [f"{digits(1)}.{digits(10)}"], [f"{digits(2)}.{digits(2)}.{digits(4)}"],
            [f"{digits(4)}/{digits(4)}"], [digits(10)], [f"{digits(3)}-{digits(4)}"], [f"{digits(2)}:{digits(2)}:{digits(2)}"],
            [":".join(f"{rng.randint(0, 255):02x}" for _ in range(6))], [f"{letters(4)}::{digits(1)}"], [f"{letters(3)}@{digits(3)}"], [f"{letters(4)}é{digits(2)}"],
            [letters(4), "at", letters(rng.randint(3, 7)), "dot", letters(rng.randint(3, 8)) + rng.choice(["", "", ",", "."])],
            [letters(5), "(at)", letters(5)], [letters(5), "[dot]", letters(5)], [f"{letters(4)}(at){letters(4)}"],
                ])
        return [(w, "O") for w in words]

    table = []
    for _ in range(lines):
        run: list[tuple[str, str]] = []
        for _ in range(rng.choice([1, 1, 1, 2, 2, 3])):
            run += rng.choice([card, phone, email, ip, other, other])()
        if rng.random() < 0.25:
            run[-1] = (run[-1][0] + rng.choice(".,;:!?)"), run[-1][1])
        table.append(([w for w, _ in run], [t for _, t in run]))
    return table


def _sound(kind: int, text: str) -> bool:
    """Whether a span of the field can be of its kind at all."""
    digits = _digits(text)
    if kind == 0:
        return bool(WIDE_EMAIL.fullmatch(_SAID.sub(_sign, text)))
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in parts) or _address(text.replace("[.]", "."))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and not text.strip("0123456789 -./_\u2013\xa0\t\n\x0b\x0c\r")
    # Nine digits at least: a date has eight.
    return 9 <= len(digits) <= 15 and not text.strip("+0123456789 ().-/\t\n\x0b\x0c\r")


def _address(text: str) -> bool:
    try:
        return bool(ipaddress.ip_address(text))
    except ValueError:
        return False


def field_spans(text: str, words: list[tuple[int, int]], labels: np.ndarray) -> Iterator[Span]:
    """Spans of one decoded run: punctuation at the outer edges does not belong to them."""
    i = 0
    while i < len(words):
        name = LABELS[labels[i]]
        j = i + 1
        if name[2:] in ("EMAIL", "CARD", "PHONE"):
            while j < len(words) and LABELS[labels[j]] == "I-" + name[2:]:
                j += 1
        if name != "O":
            kind = KINDS.index(name.split("-")[-1].lower())
            low, high = words[i][0], words[j - 1][1]
            front = _EDGE.replace("(", "") if kind == 3 else _EDGE
            while low < high and text[low] in front:
                low += 1
            while low < high and text[high - 1] in _EDGE:
                high -= 1
            if low < high and _sound(kind, text[low:high]):
                yield low, kind, high
        i = j


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text. A span of the field counts where it touches no pattern span."""
    base = [base_spans(t) for t in texts]
    found = [(i, run) for i, t in enumerate(texts) for run in runs(t)]
    labels = field.decode([[features(texts[i][a:b]) for a, b in run] for i, run in found])
    out = [(b, list(b)) for b in base]
    for (i, run), label in zip(found, labels):
        for span in field_spans(texts[i], run, label):
            if all(span[2] <= s or e <= span[0] for s, _, e in base[i]):
                out[i][1].append(span)
    return [(b, sorted(every)) for b, every in out]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or group of overlapping spans, as ``<kind>`` of its first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, keep: list[str], text: str = "text", table=None) -> DataFrame:
    """Columns ``keep`` of every row plus ``_counts`` (pattern spans per kind), ``_base``, ``_spans`` and ``_masked``.

    A null text is searched like an empty one, without spans. Offsets are code points, ends exclusive. Rows are
    searched one by one: repeated rows give equal rows. ``table``: labelled runs (words, labels), by default ``labelled_table()``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(table or labelled_table()))
    # A text that is kept travels once, beside the row.
    once = text in keep and len(keep) > 1 and isinstance(docs.schema[text].dataType, T.StringType)
    others = [k for k in keep if not (once and k == text)]
    body = F.col(f"`{text}`") if once else F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{k}`") for k in others]).alias("_row"), body.alias("_text"))
    schema = T.StructType([
        rows.schema["_row"], T.StructField("_counts", T.ArrayType(T.LongType())), T.StructField("_base", T.StringType()),
        T.StructField("_spans", T.StringType()), T.StructField("_masked", T.StringType()), *([rows.schema["_text"]] if once else []),
    ])

    def run(batches: Batches) -> Batches:
        field = shared.value
        for whole in batches:
            for batch in bounded(whole, "_text"):
                texts = [t or "" for t in batch["_text"].to_pylist()]
                found = find(texts, field)
                columns = [
                    pa.array([[sum(k == kind for _, k, _ in b) for kind in range(len(KINDS))] for b, _ in found], pa.list_(pa.int64())),
                    pa.array([written(b) for b, _ in found], pa.string()), pa.array([written(e) for _, e in found], pa.string()),
                    pa.array([masked(t, e) if e else None for t, (_, e) in zip(texts, found)], pa.string()),
                ]
                columns += [batch["_text"]] if once else []
                yield pa.RecordBatch.from_arrays([batch["_row"], *columns], names=schema.names)

    out = map_batches(rows, run, schema)
    kept = [F.col("_text" if once and k == text else f"_row.`{k}`").alias(k) for k in keep]
    return out.select(*kept, "_counts", "_base", "_spans", "_masked")


def mask(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced by its kind; ``length`` names a column that holds the text's length. Other columns may have any name."""
    return apart(docs, _mask, text=text, length=length)


def _mask(docs: DataFrame, text: str, length: str | None = None) -> DataFrame:
    found = detect(docs, list(docs.columns), text)
    body = F.coalesce("_masked", F.col(f"`{text}`"))
    new = {text: body} | ({length: F.when(F.col("_masked").isNotNull(), F.length("_masked")).otherwise(F.col(f"`{length}`"))} if length else {})
    return found.select(*[(new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`")) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op6."""
    counts = [F.get("_counts", F.lit(i)).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return detect(docs, ["doc_id"]).select("doc_id", *counts, F.sha2("_base", 256).alias("base_sha256"), F.col("_spans").alias("spans"))
