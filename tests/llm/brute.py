"""Plain versions that look at everything in one process."""

import re
from collections import defaultdict

from skerry.llm import lines


def template_keys(line):
    t = [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]
    varies = [bool(re.search("[0-9]", w)) for w in t]
    short = len(t) < lines.MIN_TOKENS
    if not t:
        return []
    if not (short and all(varies)):
        t = ["<*>" if v else w for v, w in zip(varies, t)]
    n, f, rest = len(t), lines.FIELDS, t[lines.LEAD :]
    parts = [tuple(rest[len(rest) * k // f : len(rest) * (k + 1) // f]) for k in range(f)]
    return [(n, tuple(t[: lines.LEAD]), k, tuple(p for i, p in enumerate(parts) if i != k)) for k in ([-1] if short else range(f))]


def lines_dropped(texts):
    """doc_id -> places of the lines that go."""
    homes = defaultdict(list)
    for k, text in texts.items():
        for line in (text or "").split("\n"):
            for key in template_keys(line):
                homes[key].append(k)
    first = {key: min(ids) for key, ids in homes.items()}
    return {k: [i for i, line in enumerate((text or "").split("\n")) if any(first[key] < k for key in template_keys(line))] for k, text in texts.items()}


def lines_rewritten(texts):
    out = {}
    for k, gone in lines_dropped(texts).items():
        rows = (texts[k] or "").split("\n")
        kept = [x for i, x in enumerate(rows) if i not in set(gone)]
        if not gone:
            out[k] = texts[k]
        elif any(re.search(r"[^\x20\x09-\x0D]", x) for x in kept):
            out[k] = "\n".join(kept)
    return out
