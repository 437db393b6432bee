"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field (labels: none and the kinds) is trained in numpy from a small labelled
table that this module writes by rule; its features are a word's shape and cue words, its own and its neighbours'.
Lines are decoded by Viterbi in padded numpy batches. Names, addresses and short secrets are known by the words before
them; IBANs and card numbers must also pass their checksums. A span counts only if it has what ``_holds`` asks of its
kind: a digit, a mark inside a word, or (names) a cue before it. So lines of plain words without a cue need no decoding.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in the order of the spans; the patterns find the first four, the field finds all.
KINDS = ("email", "ip", "card", "phone", "secret", "iban", "national", "name", "address")
LABELS = ("none", *KINDS)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits can only start a match at its first digit, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban(s: str) -> bool:
    """Two letters, two digits, 11 to 30 letters and digits, and the remainder that the standard asks for."""
    s = s.replace(" ", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a local part ends at its @, so it starts where the run of its characters does."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches that hold, in code points, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((3, *m.span()))
    return found


# ---- features


#: Words that announce a kind.
CUES = frozenset(
    "email mail e-mail contact write ip address host server card visa mastercard credit phone tel call mobile fax token key secret password passwd pwd api apikey api_key = : at dot iban account ssn social security passport national id number no nr born "
    "name is am called mr mrs ms dr prof dear signed regards sincerely address live lives living resides street st road rd avenue ave lane drive strasse straße rue calle platz".split()
)
#: Cues without which a name or an address isn't looked for in a line of plain words, and words that end a street's name.
_CUE = re.compile(r"(?<![^\W_])(?:my name is|name[ds]?:|mr\.?|mrs\.?|ms\.?|dr\.?|prof\.?|dear|signed|regards,?|sincerely,?|called|dot)(?!\w)", re.IGNORECASE)
_NAMED = frozenset("name named called mr mrs ms dr prof dear signed regards sincerely".split())
STREETS = "street st road rd avenue ave lane ln drive boulevard blvd square way court strasse straße platz weg allee rue calle via".split()
_STREET = re.compile(r"(?:\b(?:" + "|".join(STREETS) + r")\b|(?:strasse|straße|platz|weg|allee)\b)", re.IGNORECASE)
_ADDRESS = re.compile(r"[0-9]{1,5}[a-z]? (?:[^\W\d_][\w'-]* ){1,3}\w+\.?|[^\W\d_][\w'-]*(?: [^\W\d_][\w'-]*)* [0-9]{1,5}[a-z]?")
_RUNS = re.compile(r"(.)\1+")
_SHAPE = {c: "d" for c in range(48, 58)} | {c: "x" for c in range(97, 123)} | {c: "X" for c in range(65, 91)}
_HEX = re.compile(r"""["'`(\[]?[0-9a-fA-F]{20,}["'`)\].,;:]*\Z""")


def features(word: str) -> list[str]:
    """Shape with runs shortened, digit and length classes, marks, and the word itself if it is a cue."""
    head = word
    shape = _RUNS.sub(r"\1", "".join("x" if c.isalpha() and not c.isascii() else c for c in head.translate(_SHAPE)))
    digits = [c for c in head if "0" <= c <= "9"]
    n = len(digits)
    out = ["bias", "shape=" + (shape if len(shape) <= 12 else shape[:8] + "~" + shape[-3:])]
    out.append("digits=" + str(n if n < 5 else "5-8" if n < 9 else "9-12" if n < 13 else "13-19" if n < 20 else "20+"))
    out.append("length=" + str(min(len(word), 48) // 6))
    if 13 <= n <= 19 and luhn("".join(digits)):
        out.append("luhn")
    if iban(head.strip(".,;:")):
        out.append("iban")
    if _HEX.match(head):
        out.append("hex")
    for mark in "@+.-()\"'=/:_":
        if mark in head[1:-1] if mark != "+" else head.startswith("+"):
            out.append("mark" + mark)
    bare = word.strip("\"'()[]<>,.;!?").lower() or word
    if bare in CUES:
        out.append("cue=" + bare)
    if n and len(digits) == len(head.strip(".,;:!?")):
        out.append("alldigits")
    if bare in STREETS or bare.endswith(("strasse", "straße")):
        out.append("street")
    if head[:1].isupper() and bare.isalpha() and head[1:] == head[1:].lower():
        out.append("capital")
    return out


#: Words that are not plain: something besides letters and one closing mark. Only starts of words are tried.
_UNUSUAL = re.compile(r"(?<!\S)[^\W\d_]*+(?![.,;:!?]?(?!\S))\S+")
#: Words, and the parts between marks of words too long to have one shape (links with parameters, log fields), so that every part is seen.
LONG = 64
_TOKEN = re.compile(r"\S+")
_PARTS = re.compile(r"[^\s?&=;,|\"'{}<>]+|[?&=;,|\"'{}<>]+")


def words_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    out = []
    for m in _TOKEN.finditer(text, start, end):
        if m.end() - m.start() <= LONG:
            out.append(m.span())
        else:
            out += [p.span() for p in _PARTS.finditer(text, *m.span())]
    return out


# ---- the labelled table


def labelled_table(rows: int = 900, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """Sentences of words with a label each, written by rule: kinds in several spellings, and numbers that are none of them."""
    r = random.Random(seed)
    letters = ["th", "er", "an", "re", "ou", "en", "la", "de", "sch", "ung", "ción", "é", "ü", "es", "ti", "in"]

    def word() -> str:
        w = "".join(r.choice(letters) for _ in range(r.choice([1, 2, 2, 3, 3, 4, 5, 9])))
        return r.choice([w, w, w, w.capitalize(), w + ",", w + ".", w.upper() + "!!" if r.random() < 0.3 else w])

    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card() -> str:
        while True:
            d = r.choice("3456") + digits(15)
            if luhn(d):
                return d

    def person() -> list[str]:
        return [word().strip(".,!").lower().capitalize() for _ in range(r.choice([1, 2, 2, 2, 3]))]

    def account() -> str:
        body = r.choice(["DE", "FR", "GB", "ES"]) + "00" + digits(r.choice([18, 18, 20, 23]))
        check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:2] + "00")) % 97
        return f"{body[:2]}{check:02d}{body[4:]}"

    def kind(label: str) -> list[str]:
        name, host = word().strip(".,!").lower(), r.choice(["mail", "post", "web"]) + digits(1)
        if label == "email":
            return r.choice([[f"{name}.{digits(2)}@{host}.example.com"], [f"{name}@{host}.org"], [f"<{name}@{host}.net>,"], [name, "(at)", f"{host}.example.com"], [f"{name}[at]{host}[dot]com"], [name, "at", host, "dot", "com"], [name, "dot", name[::-1] or "x", "at", host, "dot", "org"]])
        if label == "ip":
            ip = ".".join(str(r.randint(1, 255)) for _ in range(4))
            return [r.choice([ip, ip + ",", f"({ip})", ip + ":8080", "fe80::1ff:fe23:4567:890a", f"2001:db8:{digits(4)}::8a2e:370:7334"])]
        if label == "card":
            d = card()
            return r.choice([[d], [d + ","], [d[i : i + 4] for i in range(0, 16, 4)], ["-".join(d[i : i + 4] for i in range(0, 16, 4))]])
        if label == "phone":
            a, b, c = digits(3), digits(3), digits(4)
            return r.choice([["+1", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"], [f"+49{digits(10)}"], [f"+{digits(2)}", a, b + c], [f"{a}.{b}.{c}"]])
        if label == "iban":
            a = account()
            return r.choice([[a], [a + "."], [a[i : i + 4] for i in range(0, len(a), 4)]])
        if label == "national":
            return r.choice([[f"{digits(3)}-{digits(2)}-{digits(4)}"], [f"{r.choice('ABCXYZ')}{digits(8)}"], [f"{digits(9)}"]])
        if label == "name":
            return person()
        if label == "address":
            street = r.choice(STREETS[:14]).capitalize()
            return r.choice([[str(r.randint(1, 999)), *person()[:1], street], [str(r.randint(1, 99)), *person()[:2], street + ","], [person()[0] + r.choice(["strasse", "straße"]), str(r.randint(1, 99))], [r.choice(["rue", "calle"]), *person()[:1], str(r.randint(1, 99))]])
        if r.random() < 0.25:
            return [word().strip(".,!").lower()[:10] + digits(r.choice([1, 2, 3, 4])) + r.choice(["", "!", "pw", "x"])]
        h = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64])))
        mixed = "".join(r.choice("ABCDEFGHIJKLMNabcdefghijklmn0123456789") for _ in range(r.choice([24, 36])))
        return [r.choice([f'"{h}"', f'"{h}".', h, f'"sk-{mixed}"', f'"{mixed}"', f"ghp_{mixed}", f"AKIA{mixed[:16].upper()}"])]

    def other() -> list[str]:
        return r.choice(
            [
                [str(r.randint(1900, 2099))], [digits(r.randint(1, 8))], [f"{r.randint(1, 9)}.{r.randint(0, 9)}."], ["Version", "2.0."], [f"2024-0{r.randint(1, 9)}-1{digits(1)}"],
                [f"{digits(2)}:{digits(2)}"], [f"${digits(3)}.{digits(2)}"], [word() + "&&&"], [word() + "###"], [word() + "***"], [word() + "$$$"], [word() + "%%%"], ["|"], [word() + "-" + word()],
                [f"({word()})"], [f'"{word()}"'], [digits(r.choice([9, 10, 11, 12]))], [digits(2) + "%"], [f"{digits(1)},{digits(3)},{digits(3)}"], ["CC", "BY-NC", "4.0."], [word() + "'s"], ["http://" + word() + "/" + digits(3)],
            ]
        )

    cue = {"email": ["email", "write to", "contact"], "ip": ["host", "server", "from"], "card": ["card", "visa"], "phone": ["phone", "call", "tel"], "secret": ["token =", "password =", "key:", "secret =", "password:", "pwd:", "password is"],
        "iban": ["iban", "iban:", "account"], "national": ["ssn", "ssn:", "passport", "passport no", "social security number", "social security number is", "id number", "id number is"],
        "name": ["my name is", "i am called", "mr", "mrs.", "dr.", "dear", "regards,", "name:"], "address": ["address:", "lives at", "i live at", "resides at"]}
    out = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(r.randint(1, 4)):
            filler = [word() for _ in range(r.randint(0, 4))]
            words += filler
            labels += ["none"] * len(filler)
            if r.random() < 0.5:
                part = other()
                if len(part) == 1 and len(part[0]) >= 13 and luhn(part[0]):
                    continue
                words += part
                labels += ["none"] * len(part)
            else:
                label = r.choice(KINDS)
                part = kind(label)
                # what is no more than a word or a number is known by its cue alone
                if label in ("national", "name") or label == "secret" and len(part[0]) < 20 or r.random() < 0.5:
                    before = r.choice(cue[label]).split()
                    words += before
                    labels += ["none"] * len(before)
                words += part
                labels += [label] * len(part)
        if words:
            out.append((words, labels))
    for _ in range(rows // 3):  # lines without any
        words = [word() for _ in range(r.randint(3, 10))]
        out.append((words, ["none"] * len(words)))
    return out


# ---- the field


class Field:
    """Weights: own, before and after (features x labels), moves (label to label), first (label)."""

    def __init__(self, vocabulary: dict[str, int], own: np.ndarray, before: np.ndarray, after: np.ndarray, moves: np.ndarray, first: np.ndarray):
        self.vocabulary, self.own, self.before, self.after, self.moves, self.first = vocabulary, own, before, after, moves, first
        self.rows: dict[str, np.ndarray] = {}

    def scores(self, word: str) -> np.ndarray:
        """3 x labels: the word's share in its own scores, and in those of the words after and before it."""
        known = self.rows.get(word)
        if known is None:
            at = [self.vocabulary[f] for f in features(word) if f in self.vocabulary]
            known = np.stack([self.own[at].sum(0), self.before[at].sum(0), self.after[at].sum(0)])
            if len(self.rows) >= 200_000:
                self.rows.clear()
            if len(word) <= 64:
                self.rows[word] = known
        return known

    def decode(self, lines: list[list[str]]) -> list[list[int]]:
        """Best labels of each line: Viterbi over batches of lines of like length."""
        out: list[list[int]] = [[] for _ in lines]
        order = sorted((k for k in range(len(lines)) if lines[k]), key=lambda k: len(lines[k]))
        while order:
            longest = len(lines[order[-1]])
            size = max(1, min(1024, 200_000 // longest))
            batch = [k for k in order[-size:] if 2 * len(lines[k]) >= longest or len(lines[k]) > longest - 8]
            del order[len(order) - len(batch) :]
            n = len(LABELS)
            e = np.zeros((len(batch), longest, n))
            real = np.zeros((len(batch), longest), dtype=bool)
            for b, k in enumerate(batch):
                s = np.stack([self.scores(w) for w in lines[k]])
                m = len(s)
                e[b, :m] = s[:, 0]
                e[b, 1:m] += s[:-1, 1]
                e[b, : m - 1] += s[1:, 2]
                real[b, :m] = True
            best = self.first + e[:, 0]
            back = np.zeros((len(batch), longest, n), dtype=np.int8)
            for t in range(1, longest):
                through = best[:, :, None] + self.moves
                back[:, t] = through.argmax(1)
                step = through.max(1) + e[:, t]
                best = np.where(real[:, t, None], step, best)
            label = best.argmax(1)
            labels = np.zeros((len(batch), longest), dtype=np.int8)
            for t in range(longest - 1, -1, -1):
                labels[:, t] = label
                if t:
                    label = np.where(real[:, t], back[np.arange(len(batch)), t, label], label)
            for b, k in enumerate(batch):
                out[k] = labels[b, : len(lines[k])].tolist()
        return out


def train(table: Iterable[tuple[list[str], list[str]]], rounds: int = 50, decay: float = 0.02) -> Field:
    """Maximum likelihood with a squared penalty, by Adam on forward-backward gradients over the whole (small) table."""
    table = list(table)
    vocabulary: dict[str, int] = {}
    for words, _ in table:
        for w in words:
            for f in features(w):
                vocabulary.setdefault(f, len(vocabulary))
    n, size, longest = len(LABELS), len(vocabulary), max(len(w) for w, _ in table)
    b = len(table)
    # scores and gradients are summed per distinct word; the last one stands for the places after a line's end
    index = {w: k for k, w in enumerate(dict.fromkeys(w for words, _ in table for w in words))}
    x = np.zeros((len(index) + 1, size), dtype=np.float32)
    for word, k in index.items():
        x[k, [vocabulary[f] for f in features(word)]] = 1
    at = np.full((b, longest), len(index))
    y = np.zeros((b, longest), dtype=int)
    real = np.zeros((b, longest), dtype=bool)
    for k, (words, labels) in enumerate(table):
        at[k, : len(words)] = [index[w] for w in words]
        y[k, : len(words)] = [LABELS.index(label) for label in labels]
        real[k, : len(words)] = True
    lengths = real.sum(1)
    order = np.argsort(at, axis=None)
    starts = np.searchsorted(at.ravel()[order], np.arange(len(index) + 1))
    onehot = np.eye(n, dtype=np.float32)[y] * real[..., None]

    def per_word(v: np.ndarray) -> np.ndarray:
        return np.add.reduceat(v.reshape(b * longest, n)[order], starts)

    w = [np.zeros((size, n), dtype=np.float32) for _ in range(3)] + [np.zeros((n, n), dtype=np.float32), np.zeros(n, dtype=np.float32)]
    first_m = [np.zeros_like(v) for v in w]
    second_m = [np.zeros_like(v) for v in w]

    def through(v: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Logarithms of exp(v) @ by."""
        top = v.max(1, keepdims=True)
        return np.log(np.exp(v - top) @ by) + top

    for k in range(1, rounds + 1):
        own, before, after = ((x @ v)[at] for v in w[:3])
        e = own
        e[:, 1:] += before[:, :-1]
        e[:, :-1] += after[:, 1:]
        moves, start = w[3], w[4]
        f = np.zeros((b, longest, n), dtype=np.float32)
        g = np.zeros((b, longest, n), dtype=np.float32)
        f[:, 0] = start + e[:, 0]
        step = np.exp(moves)
        for t in range(1, longest):
            f[:, t] = np.where(real[:, t, None], through(f[:, t - 1], step) + e[:, t], f[:, t - 1])
        for t in range(longest - 2, -1, -1):
            g[:, t] = np.where(real[:, t + 1, None], through(e[:, t + 1] + g[:, t + 1], step.T), 0)
        z = through(f[:, -1], np.ones((n, 1), dtype=np.float32))[:, 0]
        p = np.exp(f + g - z[:, None, None]) * real[..., None]
        pairs = np.zeros((n, n), dtype=np.float32)
        for t in range(1, longest):
            top = f[:, t - 1].max(1, keepdims=True)
            after = np.exp(np.minimum(e[:, t] + g[:, t] + top - z[:, None], 80)) * real[:, t, None]
            pairs += step * (np.exp(f[:, t - 1] - top).T @ after) - onehot[:, t - 1].T @ onehot[:, t]
        d = p - onehot
        right, left = np.zeros_like(d), np.zeros_like(d)
        right[:, :-1] = d[:, 1:]
        left[:, 1:] = d[:, :-1]
        grads = [x.T @ per_word(v) for v in (d, right, left)] + [pairs, d[:, 0].sum(0)]
        for i, grad in enumerate(grads):
            grad = grad / b + decay / b * w[i]
            first_m[i] = 0.9 * first_m[i] + 0.1 * grad
            second_m[i] = 0.999 * second_m[i] + 0.001 * grad * grad
            w[i] = w[i] - 0.1 * (first_m[i] / (1 - 0.9**k)) / (np.sqrt(second_m[i] / (1 - 0.999**k)) + 1e-8)
    assert lengths.min() > 0
    return Field(vocabulary, *[v.astype(np.float64) for v in w])


@functools.cache
def trained() -> Field:
    return train(labelled_table())


# ---- spans


def _holds(kind: str, s: str) -> bool:
    """What any span of the kind has, whatever the field says."""
    digits = sum("0" <= c <= "9" for c in s)
    if kind == "email":
        return bool(re.search(r"@|[(\[]at[)\]]", s, re.I)) and ("." in s or "dot" in s.lower()) or bool(re.fullmatch(r"\w[\w+-]*(?: dot \w+)* at \w[\w-]*(?: dot \w+)+", s, re.I))
    if kind == "iban":
        return iban(s)
    if kind == "national":
        return bool(re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{0,2}[0-9]{6,9}[A-Z]?", s))
    if kind == "name":
        return bool(re.fullmatch(r"(?:[^\W\d_][^\W\d_'.-]*(?: |\Z)){1,4}", s)) and all(w[0].isupper() and w[1:] == w[1:].lower() for w in s.split())
    if kind == "address":
        return bool(_ADDRESS.fullmatch(s) and _STREET.search(s))
    if kind == "ip":
        return s.count(".") == 3 and digits >= 4 or s.count(":") >= 2 and bool(re.fullmatch(r"[0-9A-Fa-f:.]+", s))
    if kind == "card":
        d = re.sub(r"\D", "", s)
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 7 <= digits <= 15 and not re.search(r"[^\W\d_]", s)
    return len(s) >= 8 and digits > 0 and any(c.isalpha() for c in s)


def _overlaps(a: int, b: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(x < b and a < y for _, x, y in spans)


def all_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """For each text its base spans and all spans: the field adds those that overlap no base span."""
    base = [base_spans(t) for t in texts]
    places: list[tuple[int, list[tuple[int, int]]]] = []
    lines: list[list[str]] = []
    for k, text in enumerate(texts):
        done = -1
        starts = [m.start() for m in _UNUSUAL.finditer(text)] + [m.start() for m in _CUE.finditer(text)]
        for at in sorted(starts):
            if at < done:
                continue
            start = text.rfind("\n", 0, at) + 1
            done = text.find("\n", at)
            done = len(text) if done < 0 else done
            spans = words_of(text, start, done)
            places.append((k, spans))
            lines.append([text[a:b] for a, b in spans])
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (k, spans), labels in zip(places, field.decode(lines)):
        text, t = texts[k], 0
        while t < len(labels):
            end = t + 1
            if labels[t]:
                while end < len(labels) and labels[end] == labels[t]:
                    end += 1
                a, b = spans[t][0], spans[end - 1][1]
                while a < b and text[a] in "\"'<[`,;:=" or a < b and text[a] == "(" and ")" not in text[a:b]:
                    a += 1
                while a < b and (text[b - 1] in "\"'>]`,;:.!?#$%&*|" or text[b - 1] == ")" and "(" not in text[a:b]):
                    b -= 1
                kind = labels[t] - 1
                before = [text[x:y].strip("\"'()[]<>,.;:!?").lower() for x, y in spans[max(0, t - 3) : t]]
                named = KINDS[kind] != "name" or not _NAMED.isdisjoint(before)
                if a < b and named and _holds(KINDS[kind], text[a:b]) and not _overlaps(a, b, base[k]):
                    added[k].append((kind, a, b))
            t = end
    return [(x, sorted(x + y)) for x, y in zip(base, added)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


FIELDS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def find(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """doc_id, the counts of base spans, the sha256 of their listing, the listing of all spans, and their number.

    One pass over the rows without a shuffle; the model (under 1 MB, fixed by the labelled table) goes to the executors
    as a broadcast value. Null and empty texts have no spans; a null doc_id stays null; repeated rows give repeated
    results; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or trained())

    @F.pandas_udf(FIELDS)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for texts in batches:
            texts = [x or "" for x in texts]
            rows = []
            for at in range(0, len(texts), 500):
                for base, spans in all_spans(texts[at : at + 500], sent.value):
                    n = [sum(k == kind for kind, _, _ in base) for k in range(4)]
                    rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans)))
            yield pd.DataFrame(rows, columns=names)

    return docs.select("doc_id", scanned("text").alias("found")).select("doc_id", "found.*")
