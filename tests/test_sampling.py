"""The samples of a file against plain loops."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np

from lexstrata.operators import structure as S
from lexstrata.operators.sampling import CUT, fill, language_text, page_text
from lexstrata.plans import registry


def by_file(rows):
    files = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.seq):
        if r.testo and r.testo.strip():
            files[r.file].append((r, r.testo.strip()))
    return files


def language(texts):
    head, rest = texts[:40], texts[40:]
    short = [t for t in rest if len(t) <= 80 and re.search(r"\d", t) and re.search(r"[^\W\d_]", t)]
    short = short[:: max(1, len(short) // 40)][:40]
    spread = rest[:: max(1, len(rest) // 60)][:60]
    kept, seen, used = [], set(), 0
    for t in head + short + spread:
        if t in seen or (kept and used + len(t) + 1 > 6000):
            continue
        seen.add(t)
        kept.append(t)
        used += len(t) + 1
    return "\n".join(kept)


def sample(blocks):
    pages = sorted({r.page for r, _ in blocks if r.page is not None})
    first = {}
    for r, _ in blocks:
        if r.page is not None and r.structural:
            first.setdefault(r.structural, r.page)
    chosen = {first[k] for k in ("article", "title", "chapter", "section", "annex", "recital") if k in first}
    chosen |= {pages[int(round(p))] for p in np.linspace(0, len(pages) - 1, min(5, len(pages)))} if pages else set()
    lines = [f"[page={r.page} order={r.page_order} tipo_ocr={r.block_type}] {t}" for r, t in blocks if r.page in chosen]
    kept, used = [], 0
    for line in lines:
        if kept and used + len(line) + 1 > 12000:
            break
        kept.append(line)
        used += len(line) + 1
    return sorted(chosen), "\n".join(kept) + (CUT if len(kept) < len(lines) else "")


def test_samples_equal_the_loops(spark):
    from lexstrata.sources.blocks import delivered_blocks

    data = "/root/testdata/sf0.01"
    files = by_file(S.prepared(delivered_blocks(spark, data)).collect())
    texts = {r.file: r.text for r in registry.queries()["language_sample_text"](spark, data).collect()}
    assert texts == {f: language([t for _, t in blocks]) for f, blocks in files.items()}
    pages = {r.file: (r.pages, r.text) for r in registry.queries()["page_sample_text"](spark, data).collect()}
    assert pages == {f: sample(blocks) for f, blocks in files.items()}
    spaced = defaultdict(set)
    for r in registry.queries()["page_sample"](spark, data).collect():
        spaced[r.file].add(r.page)
    assert any(set(p) - spaced[f] for f, (p, _) in pages.items()) and any(t.endswith(CUT) for _, t in pages.values())


def test_made_file(spark):
    rows = [("f", n, n // 3 if n < 290 else None, n % 3, n, "CAPO IV" if n == 200 else f"Art. {n}" if n == 151 else "  testo lungo " + "x " * 60 + str(n), "it", "text", False) for n in range(300)]
    rows += [("g", 1000, None, None, 0, "solo", "it", None, False), ("h", 1001, 1, 1, 0, "y" * 7000, "it", None, False), ("h", 1002, 1, 2, 1, None, "it", None, False), ("h", 1003, 1, 3, 2, "  ", "it", None, False)]
    df = spark.createDataFrame(rows, "file string, block_id bigint, page int, page_order int, ordine int, testo string, profile string, block_type string, recovered_extra_candidate boolean")
    prepared = S.prepared(df)
    files = by_file(prepared.collect())
    got = {r.file: r.text for r in language_text(df).collect()}
    assert got == {f: language([t for _, t in blocks]) for f, blocks in files.items()}
    assert "Art. 151" in got["f"].split("\n") and len(got["f"]) <= 6000 and len(got["h"]) == 7000
    found = {r.file: (r.pages, r.text) for r in page_text(prepared).collect()}
    assert found == {f: sample(blocks) for f, blocks in files.items()}
    assert {50, 66} <= set(found["f"][0]) and found["g"] == ([], "")
    assert language_text(df.where("false")).count() == 0 and page_text(prepared.where("false")).count() == 0


def test_fill_goes_on():
    assert fill(["a" * 5, "b" * 9, "c", "c", "d" * 4], 10) == ["a" * 5, "c"]
