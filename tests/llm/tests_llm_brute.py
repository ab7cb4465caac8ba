"""Plain Python forms of the pipeline's stages."""

import re

from test_llm_decontaminate import words
from test_llm_language import brute as predicted  # noqa: F401
from test_llm_secrets import BASE
from test_llm_simhash import brute_components, brute_fp

from lapengine.llm import secrets


def simhash_components(rows):
    ids = [i for i, _ in rows]
    return dict(zip(ids, brute_components(ids, [brute_fp(t) for _, t in rows]), strict=True))


def contaminated(text, items):
    w, hit = words(text), set()
    for _, t in items:
        v = words(t)
        m = min(13, len(v))
        grams = {tuple(v[s:s + m]) for s in range(len(v) - m + 1)} if m else set()
        hit |= {s + k for s in range(len(w) - m + 1) if tuple(w[s:s + m]) in grams for k in range(m)}
    return len(hit) > 0 and 20 * len(hit) >= len(w)


def secret_free(text):
    spans = [(m.start(), m.end()) for _, p, ok in BASE for m in p.finditer(text) if ok(m)]
    spans += [(m.start(), m.end()) for r in secrets.ADDED_RULES for m in re.finditer(r.pattern, text)]
    out, at = "", 0
    for s, e in sorted(spans):
        if s >= at:
            out += text[at:s] + "[secret]"
        at = max(at, e)
    return out + text[at:]
