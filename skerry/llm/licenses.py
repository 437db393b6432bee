"""License scans: exact phrases, and short notices with a bounded number of edits.

Fuzzy search in three steps. A notice that may have k edits has been cut into k + 3 pieces beforehand; three of them occur
unchanged (pigeonhole), at distances that k edits allow, so one pass of an automaton of all pieces finds every candidate
place. There a bit-parallel pass gives the fewest edits that any stretch needs, in time that follows the stretch's length:
ordinary prose about licenses ends here. What is left the regex library matches with a bounded number of errors, around
the place that is known by then, and gives its span. Of spans that lie inside
another one the longer notice stays ("creative commons attribution" in "creative commons attribution sharealike").
"""

from __future__ import annotations

import bisect
import dataclasses
import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices in the words of the scan, their labels, and the edits (characters) that each may have.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache", 5),
    ("apache license version 2 0", "apache", 3),
    ("gnu general public license", "gpl", 3),
    ("gnu general public license version", "gpl", 4),
    ("gnu lesser general public license", "lgpl", 4),
    ("gnu library general public license", "lgpl", 4),
    ("gnu affero general public license", "agpl", 4),
    ("gnu free documentation license", "gfdl", 3),
    ("this program is free software you can redistribute it and or modify it", "gpl", 8),
    ("without even the implied warranty of merchantability or fitness for a particular purpose", "gpl", 9),
    ("creative commons attribution", "cc-by", 3),
    ("creative commons attribution sharealike", "cc-by-sa", 4),
    ("creative commons attribution share alike", "cc-by-sa", 4),
    ("creative commons attribution noncommercial", "cc-by-nc", 4),
    ("creative commons attribution noderivatives", "cc-by-nd", 4),
    ("creative commons attribution noncommercial sharealike", "cc-by-nc-sa", 5),
    ("creative commons attribution noncommercial noderivatives", "cc-by-nc-nd", 5),
    ("creative commons zero", "cc0", 2),
    ("cc0 1 0 universal", "cc0", 1),
    ("licensed under a creative commons attribution", "cc-by", 5),
    ("licensed under cc by", "cc-by", 1),
    ("licensed under cc by nc", "cc-by-nc", 1),
    ("licensed under cc by sa", "cc-by-sa", 1),
    ("licensed under cc by nd", "cc-by-nd", 1),
    ("cc by sa", "cc-by-sa", 0),
    ("cc by nc", "cc-by-nc", 0),
    ("cc by nd", "cc-by-nd", 0),
    ("cc by nc sa", "cc-by-nc-sa", 0),
    ("cc by nc nd", "cc-by-nc-nd", 0),
    ("released under the mit license", "mit", 3),
    ("licensed under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 8),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit", 9),
    ("redistribution and use in source and binary forms with or without", "bsd", 8),
    ("bsd 2 clause", "bsd", 0),
    ("bsd 3 clause", "bsd", 0),
    ("2 clause bsd", "bsd", 0),
    ("3 clause bsd", "bsd", 0),
    ("simplified bsd license", "bsd", 2),
    ("new bsd license", "bsd", 0),
    ("bsd license", "bsd", 0),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc", 10),
    ("isc license", "isc", 0),
    ("boost software license", "bsl", 2),
    ("mozilla public license", "mpl", 2),
    ("mozilla public license version 2 0", "mpl", 4),
    ("eclipse public license", "epl", 2),
    ("common development and distribution license", "cddl", 4),
    ("common public license", "cpl", 2),
    ("european union public licence", "eupl", 3),
    ("academic free license", "afl", 2),
    ("artistic license 2 0", "artistic", 1),
    ("microsoft public license", "ms-pl", 2),
    ("python software foundation license", "psf", 3),
    ("server side public license", "sspl", 2),
    ("business source license", "busl", 2),
    ("sil open font license", "ofl", 2),
    ("open database license", "odbl", 2),
    ("open data commons attribution license", "odc-by", 3),
    ("zlib license", "zlib", 0),
    ("this is free and unencumbered software released into the public domain", "unlicense", 7),
    ("dedicated to the public domain", "public-domain", 3),
    ("all rights reserved", "proprietary", 1),
    ("may not be reproduced or distributed without permission", "proprietary", 5),
)
#: Identifiers after "SPDX-License-Identifier:", in the words of the scan, and their labels.
SPDX = {
    "apache 2 0": "apache", "mit": "mit", "isc": "isc", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl",
    "mpl 2 0": "mpl", "epl 2 0": "epl", "cddl 1 0": "cddl", "bsl 1 0": "bsl", "cc0 1 0": "cc0", "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc", "unlicense": "unlicense", "zlib": "zlib",
}

#: ASCII letters to lower case, ASCII letters and digits and all beyond ASCII kept, the rest to a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


#: Pieces of a notice beyond one for each edit; so many must occur unchanged.
SPARE = 2


@dataclasses.dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int
    masks: dict[str, int]

    @functools.cached_property
    def needed(self) -> int:
        """Pieces that a text with all edits still has."""
        return len(self.cuts) - 1 - self.edits

    @functools.cached_property
    def cuts(self) -> list[int]:
        """Ends of the pieces; those of a short notice would be too small to tell anything with SPARE more."""
        n, spare = len(self.text), SPARE if self.edits > 1 else 0
        pieces = self.edits + 1 + spare
        return [n * k // pieces for k in range(pieces + 1)]

    def pattern(self, edits: int):
        return _pattern(self.text, edits)


@functools.cache
def _pattern(text: str, edits: int):
    import regex

    # whole words: an edited notice still stands between spaces, which are at both ends of what is searched
    body = regex.escape(text)
    return regex.compile(rf"(?<=\s)(?:{body}){{e<={edits}}}(?=\s)" if edits else rf"(?<=\s){body}(?=\s)")


@functools.cache
def _notices() -> tuple[tuple[Notice, ...], object]:
    """The notices, and an automaton of their pieces that gives (notice, number of the piece, its place) for each."""
    import ahocorasick

    notices, pieces = [], {}
    for text, label, edits in NOTICES:
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | 1 << i
        notice = Notice(text, label, edits, masks)
        for i, (x, y) in enumerate(zip(notice.cuts, notice.cuts[1:])):
            pieces.setdefault(text[x:y], []).append((len(notices), i, x))
        notices.append(notice)
    automaton = ahocorasick.Automaton()
    for piece, places in pieces.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return tuple(notices), automaton


@functools.cache
def _expression():
    """An SPDX line's identifiers, joined by or, and, with."""
    import regex

    names = "|".join(sorted(map(regex.escape, SPDX), key=len, reverse=True))
    return regex.compile(rf"(?<=\s)(?:spdx license identifier){{e<=1}}(?: (?:or |and )?({names})(?: only| or later)?(?=\s))+")


def near_ends(notice: Notice, text: str) -> Iterator[tuple[int, int]]:
    """Where stretches of the text end that are the notice with no more than its edits, and how many they need.

    Bit-parallel: one step of whole-number arithmetic for each character, so the time follows the text's length. Of ends
    that follow one another the first with the fewest edits is given.
    """
    n, most = len(notice.text), notice.edits
    top, whole = 1 << (n - 1), (1 << n) - 1
    up, down, score = whole, 0, n
    masks = notice.masks
    best: tuple[int, int] | None = None
    for at, c in enumerate(text, 1):
        same = masks.get(c, 0)
        across = (((same & up) + up) ^ up) | same | down
        more, less = down | (~(across | up) & whole), up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more, less = more << 1 & whole, less << 1 & whole
        up, down = less | (~((same | down) | more) & whole), more & (same | down)
        if score <= most:
            if best is None or score < best[1]:
                best = (at, score)
        elif best:
            yield best
            best = None
    if best:
        yield best


def regions(notice: Notice, seeds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """seeds: (place at which the notice would begin, piece) -> stretches of the text where enough pieces of one begin closely enough."""
    seeds.sort()
    out: list[tuple[int, int]] = []
    have: dict[int, int] = {}
    first = 0
    for at, piece in seeds:
        have[piece] = have.get(piece, 0) + 1
        while at - seeds[first][0] > notice.edits:  # insertions and deletions shift later pieces by one each
            gone = seeds[first][1]
            have[gone] -= 1
            if not have[gone]:
                del have[gone]
            first += 1
        if len(have) >= notice.needed:
            start, end = seeds[first][0] - notice.edits - 1, at + len(notice.text) + notice.edits + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], max(end, out[-1][1]))
            else:
                out.append((start, end))
    return out


def words_of(text: str) -> list[str]:
    return [w for w in text.encode("utf-8", "surrogatepass").translate(_WORDS).decode("utf-8", "surrogatepass").split(" ") if w]


def exact_places(joined: str) -> list[tuple[int, str]]:
    """(character, label) of the space before each place where a phrase's words stand one after the other; joined: ' w0 w1 .. '."""
    found = []
    for phrase, label in PHRASES.items():
        at = joined.find(f" {phrase} ")
        while at >= 0:
            found.append((at, label))
            at = joined.find(f" {phrase} ", at + 1)
    return found


def fuzzy_spans(joined: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, label, errors, notice length) of notices with at most their number of edits, in characters of joined."""
    notices, automaton = _notices()
    seeds: dict[int, list[tuple[int, int]]] = {}
    for last, (size, of) in automaton.iter(joined):
        for k, piece, offset in of:
            seeds.setdefault(k, []).append((last + 1 - size - offset, piece))
    found = []
    for number, places in seeds.items():
        notice = notices[number]
        n, k = len(notice.text), notice.edits
        for start, end in regions(notice, places):
            start = max(0, start)
            free = 0  # what an earlier match took is not searched again
            for at, errors in near_ends(notice, joined[start:end]) if k else ((end - start, 0),):
                low, high = max(free, start + at - n - 2 * k - 2 if k else start), min(len(joined), start + at + k + 2)
                for most in sorted({errors, k}):
                    for m in notice.pattern(most).finditer(joined, low, high):
                        found.append((m.start(), m.end(), notice.label, sum(m.fuzzy_counts), n))
                        free = m.end()
                    if free > low:
                        break
    for m in _expression().finditer(joined):
        for a, b, name in zip(m.starts(1), m.ends(1), m.captures(1)):
            found.append((a, b, SPDX[name], sum(m.fuzzy_counts), len("spdx license identifier ") + len(name)))
    found.sort(key=lambda x: (x[0], -x[1], x[3]))
    kept, reach = [], -1
    for x in found:  # those inside an earlier one go
        if x[1] > reach:
            kept.append(x)
            reach = x[1]
    return kept


def scan(text: str) -> dict:
    words = words_of(text)
    joined = f" {' '.join(words)} " if words else " "
    base = exact_places(joined)
    fuzzy = fuzzy_spans(joined)
    base_labels = {label for _, label in base}
    labels = base_labels | {x[2] for x in fuzzy}
    score = 1.0 if base else max((1 - errors / length for *_, errors, length in fuzzy), default=0.0)
    # one pass gives the number of a word from its place
    gaps = [i for i, c in enumerate(joined) if c == " "] if base or fuzzy else []
    places = [bisect.bisect_left(gaps, at) for at, _ in base]
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": score,
        "spans": [{"start_word": bisect.bisect_left(gaps, a) - 1, "end_word": bisect.bisect_left(gaps, b), "label": label, "errors": errors} for a, b, label, errors, _ in fuzzy],
    }


FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<start_word: long, end_word: long, label: string, errors: long>>"
)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, the exact phrases' counts and places, labels, score and the notices' spans in words, end exclusive.

    score: 1 with an exact phrase, else 1 - errors / length of the best notice, else 0. Null and empty texts have no
    words, null places, empty labels and score 0; a null doc_id stays null; repeated rows give repeated results; other
    columns are ignored, whatever their names; an empty table gives no rows.
    """

    @F.pandas_udf(FIELDS)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(", ")][:8]
        for texts in batches:
            out = pd.DataFrame([scan(x or "") for x in texts], columns=names[:7] + ["spans"])
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return docs.select("doc_id", scanned("text").alias("found")).select("doc_id", "found.*")
