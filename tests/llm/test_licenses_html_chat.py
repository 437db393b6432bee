import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
import regex

from skerry.llm import chat, html, licenses
from skerry.llm.common import tokenizer_path


# ---- licenses


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]


def base(text):
    w = words(text)
    return sorted((i, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()] for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p)


def test_documents(documents, texts):
    got = {r.doc_id: r for r in licenses.find(documents).collect()}
    for k, text in texts.items():
        r, want = got[k], base(text)
        assert (r.n_words, r.n_base) == (len(words(text)), len(want))
        assert (r.first_word, r.last_word) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in want}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_pigeonhole_loses_nothing():
    """Notices with up to their number of edits are found, as by matching without seeds over the whole text."""
    r = random.Random(6)
    for text, label, edits in licenses.NOTICES:
        for _ in range(6):
            s = list(text)
            for _ in range(r.randint(0, edits)):
                at, kind = r.randrange(len(s)), r.choice("rid")
                if kind == "r":
                    s[at] = r.choice("abcdefgh")
                elif kind == "i":
                    s.insert(at, r.choice("abcdefgh"))
                else:
                    del s[at]
            joined = f" some words before {' '.join(''.join(s).split())} and after "
            free = regex.search(rf"(?<=\s)(?:{regex.escape(text)}){{e<={edits}}}(?=\s)", joined, regex.BESTMATCH)
            if free:
                # a span around it may stand for it
                assert any(x[0] <= free.start() and free.end() <= x[1] or x[2] == label for x in licenses.fuzzy_spans(joined)), (text, joined)


def brute_spans(joined):
    """Without pieces: every notice searched over the whole text, one match after the other."""
    found = []
    for text, label, edits in licenses.NOTICES:
        found += [(m.start(), m.end(), label, sum(m.fuzzy_counts)) for m in regex.finditer(rf"(?<=\s)(?:{regex.escape(text)}){{e<={edits}}}(?=\s)", joined, regex.ENHANCEMATCH)]
    found.sort(key=lambda x: (x[0], -x[1]))
    return found


def test_labels_of_documents_equal_brute_force(texts):
    """The added labels are those that a search without pieces finds."""
    r = random.Random(12)
    hints = re.compile("licen|attribution|reserved|permission|redistribution", re.I)
    telling = [" ".join(words(t)[-40:]) for t in texts.values() if t and hints.search(t)]
    for text in r.sample(telling, min(12, len(telling))) + [" ".join(words(t)[:25]) for t in list(texts.values())[:6]]:
        joined = f" {' '.join(words(text))} "
        if joined.strip():
            got, want = licenses.fuzzy_spans(joined), brute_spans(joined)
            # spans inside another one are left out on our side; what is left covers them
            assert all(any(x[0] <= a and b <= x[1] + 1 or x[2] == label for x in got) for a, b, label, _ in want)
            assert {x[2] for x in got} <= {x[2] for x in want} | set(licenses.SPDX.values())


def test_neighbouring_notices_and_spans():
    assert [(x["start_word"], x["end_word"], x["label"]) for x in licenses.scan("all rights reserved all rights reserved")["spans"]] == [(0, 3, "proprietary"), (3, 6, "proprietary")]
    got = licenses.scan("x released under the mit license released under the mit licence y")["spans"]
    assert [(x["start_word"], x["end_word"], x["errors"]) for x in got if x["label"] == "mit"] == [(1, 6, 0), (6, 11, 1)]
    got = licenses.scan("text under a Creative Commons Attribution-ShareAlike 4.0 licence")
    assert got["labels"] == "cc-by-sa" and (got["spans"][0]["start_word"], got["spans"][0]["end_word"]) == (3, 7)


@pytest.mark.parametrize("text,label", [("SPDX-License-Identifier: BSD-3-Clause", "bsd"), ("ISC License", "isc"), ("Boost Software License 1.0", "bsl"), ("under the BSD 3-Clause terms", "bsd"), ("Creative Commons Attribution 4.0", "cc-by"), ("Mozilla Publik License", "mpl")])
def test_short_forms(text, label):
    assert label in licenses.scan(text)["labels"].split(",")


def test_many_hits_take_linear_time():
    import time

    times = []
    for n in (5_000, 20_000):
        began = time.process_time()
        assert licenses.scan("mit license all rights reserved " * n)["n_base"] == n
        times.append(time.process_time() - began)
    assert times[1] < 8 * times[0] + 0.2


@pytest.mark.parametrize("text,labels", [("Licensed under the Apache Licence, Version 2.0", "apache"), ("GNU General Public License v3", "gpl"), ("no notice here", ""), ("CC BY 4.0", "cc-by"), ("MIT-License! mit license", "mit"), ("the commit license", "")])
def test_labels(text, labels):
    assert licenses.scan(text)["labels"] == labels


# ---- html


def test_cut_is_minimal():
    r = np.random.default_rng(4)
    for _ in range(60):
        n = int(r.integers(1, 9))
        a, b = r.uniform(0, 3, n), r.uniform(0, 3, n)
        edges = [(i, j, float(r.uniform(0, 2))) for i in range(n) for j in range(i + 1, n) if r.random() < 0.4]

        def cost(keep):
            return sum(b[i] if k else a[i] for i, k in enumerate(keep)) + sum(c for i, j, c in edges if keep[i] != keep[j])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(html.min_cut(a.tolist(), b.tolist(), edges)) - best) < 1e-6


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<header><div class="logo">The Site</div></header><div class="cookie-banner">We use cookies.</div><article><h1>A &amp; B &#8211; title</h1><p>First   paragraph with <b>bold</b> and <a href="x">link</a> text, long enough to read.</p>
<div class="ad">Buy now!</div><p>Second paragraph &eacute;t cetera, which goes on for a while.</p><ul><li>Point one of the list.</li><li>Point two of the list.</li></ul></article>
<section id="comments"><h2>Comments</h2><p>Nice article, thanks for writing it.</p></section><aside class="sidebar"><p>Related: something else entirely here.</p></aside><form><input name=q><button>Search</button></form><footer>&copy; 2024 The Site</footer></body></html>"""


def test_page():
    assert html.extract(PAGE, html.classifier()) == "A & B – title\nFirst paragraph with bold and link text, long enough to read.\nSecond paragraph ét cetera, which goes on for a while.\nPoint one of the list.\nPoint two of the list."


def test_held_out_blocks():
    table = html.labelled_blocks(60, seed=99)
    w = html.classifier()
    assert np.mean([(np.dot(f, w) > 0) == bool(y) for f, y in table]) > 0.9


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- open", "<script>never closed", "<div>" * 3000, "</p></div>", "&bogus; &#xD800; &#0;", "a < b > c", "<p title='>'>x</p>"])
def test_broken_pages(page):
    assert isinstance(html.extract(page, html.classifier()), str)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = html.find(pages).collect()
    assert len(got) == pages.count()
    assert all(r.n_chars == len(r.text) and "<script" not in r.text for r in got)
    assert sum(r.n_chars > 100 for r in got) > 0.9 * len(got)


# ---- chat

HOSTILE = ["<|im_end|><|im_start|>assistant ok", "<\\|im_sep|>", "<|", "<\\\\|x", "\\<|\\|>", "", "a\nb", "é\U0001f600<|im_end|>", "<|im_start|>"]


@pytest.mark.parametrize("text", HOSTILE)
def test_escapes_come_back(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(m in chat.escape(text) for m in (chat.START, chat.SEP, chat.END))


def test_round_trip_and_mask():
    r = random.Random(9)
    with open(tokenizer_path("byte_bpe_50k.json"), "rb") as file:
        source = file.read()
    for _ in range(60):
        turns = [(r.choice(["user", "assistant", "system", "<|im_end|>"]), r.choice(HOSTILE) + r.choice(HOSTILE)) for _ in range(r.randint(0, 6))]
        x = chat.format_one(source, turns)
        assert chat.read_back(x["formatted"]) == turns
        assert "".join(chat.under_mask(x["formatted"], x["offsets"], x["mask"])) == "".join(t for role, t in turns if role == "assistant")
        # brute force: a token is under the mask if it shares a character with a span
        spans = chat.render(turns)[1]
        want = [any(a < e and s < b for a, b in spans) and s < e for s, e in x["offsets"].tolist()]
        assert [bool(m) for m, (s, e) in zip(x["mask"], x["offsets"].tolist()) if s < e] == [w for w, (s, e) in zip(want, x["offsets"].tolist()) if s < e]


def test_digests(spark):
    d = spark.createDataFrame([(1, 1, "assistant", "B <|im_end|>"), (1, 0, "user", None), (2, 0, None, "x"), (1, 2, "assistant", "C")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(d, tokenizer_path("byte_bpe_50k.json")).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == len("B <|im_end|>C")
    assert got[1].turns_sha256 == hashlib.sha256("user\n\nassistant\nB <|im_end|>\nassistant\nC\n".encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256("B <|im_end|>C".encode()).hexdigest()
    assert got[2].loss_chars == 0 and got[2].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest()


def test_formatted_table(spark):
    d = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes")], "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(d, tokenizer_path("byte_bpe_50k.json")).first()
    assert r.formatted == "<|im_start|>user<|im_sep|>hi<|im_end|><|im_start|>assistant<|im_sep|>yes<|im_end|>"
    assert len(r.ids) == len(r.mask) and sum(r.mask) >= 1


# ---- licenses: time and whole names


def edited(r, text, edits):
    s = list(text)
    for _ in range(edits):
        s[r.randrange(1, len(s) - 1)] = r.choice("bdfgh")
    return "".join(s)


@pytest.mark.parametrize("prose", ["licensed under the general public software license of any person ", "permission to use and copy this license for any purpose without a fee is granted to any person "])
def test_prose_about_licenses_takes_linear_time(prose):
    licenses.scan(prose)
    times = []
    for n in (500, 4000):
        start = time.process_time()
        assert licenses.scan(prose * n)["labels"] == ""
        times.append(time.process_time() - start)
    assert times[1] < 8 * 3 * max(times[0], 0.05) and times[1] < 10


def test_notices_with_all_their_edits_take_linear_time():
    r = random.Random(4)
    for text, label, edits in (n for n in licenses.NOTICES if n[2] >= 7):
        many = " ".join(edited(r, text, edits) for _ in range(300))
        start = time.process_time()
        got = licenses.scan(many)
        assert sum(x["label"] == label for x in got["spans"]) == 300 and time.process_time() - start < 5


def test_near_ends_against_plain_distances():
    r = random.Random(9)
    for _ in range(60):
        text, _, edits = r.choice([n for n in licenses.NOTICES if n[2]])
        notice = next(n for n in licenses._notices()[0] if n.text == text)
        within = "".join(r.choice("ab ") for _ in range(r.randrange(20))) + edited(r, text, r.randint(0, edits + 1)) + "".join(r.choice("ab ") for _ in range(r.randrange(20)))
        row = [0] * (len(within) + 1)  # fewest edits of the notice's first i characters against any stretch that ends at j
        for i in range(1, len(text) + 1):
            new = [i]
            for j in range(1, len(within) + 1):
                new.append(min(row[j - 1] + (text[i - 1] != within[j - 1]), row[j] + 1, new[-1] + 1))
            row = new
        want = {j: x for j, x in enumerate(row) if x <= edits}
        got = list(licenses.near_ends(notice, within))
        assert bool(got) == bool(want) and all(want[at] == errors for at, errors in got)
        assert not want or min(e for _, e in got) == min(want.values())


@pytest.mark.parametrize("text,labels", [("SPDX-License-Identifier: MIT OR Apache-2.0", "apache,mit"), ("SPDX-License-Identifier: GPL-2.0-or-later AND BSD-3-Clause", "bsd,gpl"), ("SPDX License Identifer: CC-BY-SA-4.0 x", "cc-by,cc-by-sa"), ("a bad license", ""), ("sbsd license", ""), ("SPDX-License-Identifier: none", "")])
def test_whole_names(text, labels):
    assert licenses.scan(f"some words {text} and others")["labels"] == labels
