"""The licence scan against brute force over every window, and its template set."""

from __future__ import annotations

import random

import pytest

from samplewright.llm import licenses

SCHEMA = "doc_id long, text string"
MARKS = "".join(chr(b) for b in range(0x21, 0x7F) if not chr(b).isalnum())


def brute_words(text):
    """(place, word) of each word that isn't punctuation alone."""
    return [(k, w.strip(MARKS).lower()) for k, w in enumerate(text.split()) if w.strip(MARKS)]


def brute(docs, templates):
    found = set()
    for key, text in docs:
        own = brute_words(text)
        runs = [tuple(w for _, w in own[i : i + 5]) for i in range(len(own) - 4)]
        for name, template in templates.items():
            words = [w for _, w in brute_words(template)]
            wanted = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
            width = len(wanted) + len(wanted) // 4
            best = max(((len(wanted & set(runs[i : i + width])), -i) for i in range(len(runs))), default=(0, 0))
            if best[0] / len(wanted) >= 0.8:
                start = -best[1]
                first = next(i for i in range(start, len(runs)) if runs[i] in wanted)
                found.add((key, name, round(best[0] / len(wanted), 9), own[first][0], len(template.split())))
    return found


def scanned(spark, docs, templates):
    rows = licenses.scan_licenses(spark.createDataFrame(docs, SCHEMA), templates, licenses.Scan(bare=True)).collect()
    out = {(r["doc_id"], r["license"], round(r["containment"], 9), r["first_word"], r["n_words"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_scan_equals_brute_force_at_every_place(spark):
    rng = random.Random(7)
    filler = [f"w{k}" for k in range(200)] + ["*", "//", "--"]
    templates = {k: v for k, v in licenses.NOTICES.items() if len(v.split()) > 20}
    docs = []
    for k in range(150):
        body = [rng.choice(filler) for _ in range(rng.randint(0, 200))]
        notice = rng.choice(list(templates.values())).split()
        for _ in range(rng.randint(0, 2)):
            notice[rng.randrange(len(notice))] = "changed"
        for _ in range(rng.choice([0, 2, 8, 12])):  # stretched, in one place or many
            notice.insert(rng.choice([len(notice) // 2, rng.randrange(len(notice))]), "put")
        at = rng.randint(0, len(body))
        body[at:at] = notice + (notice[: len(notice) // 2] if k % 3 == 0 else [])  # with repeated shingles
        docs.append((k, " ".join(body)))
    expected = brute(docs, templates)
    assert len(expected) > 40
    assert scanned(spark, docs, templates) == expected


@pytest.mark.parametrize("mark", [" * ", "// ", "# ", ";; ", "-- ", "/* ", "//"])
def test_headers_in_comment_blocks(spark, mark):
    words = licenses.NOTICES["GPL header"].split()
    lines = "\n".join(mark + " ".join(words[k : k + 7]) for k in range(0, len(words), 7))
    assert ("GPL header", 1.0) in {r[1:3] for r in scanned(spark, [(1, lines)], licenses.NOTICES)}
