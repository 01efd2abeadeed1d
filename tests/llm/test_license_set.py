"""Which licenses the scan's default templates cover."""

from __future__ import annotations

import pytest

from samplewright.llm import licenses, queries


@pytest.fixture
def query(spark, tmp_path):
    """What the registered query finds: (doc_id, license)."""

    def run(docs):
        spark.createDataFrame(docs, "doc_id string, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
        return {(r["doc_id"], r["license"]) for r in queries.op1_license_scan(spark, f"file://{tmp_path}").collect()}

    return run


def test_whole_licenses_are_found(query):
    texts = licenses.full_texts()
    wanted = {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"}
    assert {f"{x} text" for x in wanted} <= set(texts)
    found = query([(n, f"some words before\n{t}\nand after") for n, t in texts.items()])
    assert {(n, n) for n in texts} <= found


def test_notices_whatever_stands_around_them(query):
    cases = [
        ("MIT", "Released under the MIT License, as all of it"),
        ("MIT", "It is released under the MIT License and more"),
        ("MIT", "(Released under the “MIT License”)"),
        ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
        *((name, f"* {notice.rstrip(".:")};") for name, notice in licenses.MORE_NOTICES.items()),
    ]
    found = query([(str(k), text) for k, (_, text) in enumerate(cases)])
    assert {(str(k), name) for k, (name, _) in enumerate(cases)} <= found
