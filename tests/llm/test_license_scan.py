import re
import time

import pytest

from gleanstar.llm import license_scan as ls
from gleanstar.llm.license_texts import TEMPLATES
from gleanstar.llm.registry import table


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)


def bigrams(w):
    return set(zip(w, w[1:], strict=False))


def brute(text, templates=TEMPLATES, t=ls.THRESHOLD):
    """All runs of units against all templates."""
    units = [words(u) for u in re.split(r"(?<=\n)|(?<=[!.;?] )", text or "")]
    units = [u for u in units if u]
    found = {}
    for name, other in templates.items():
        b = bigrams(words(other))
        for i in range(len(units)):
            run = []
            for j in range(i, len(units)):
                run = run + units[j]
                a = bigrams(run)
                dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
                if dice >= t:
                    found[name] = max(found.get(name, 0), dice)
    best = min(found, key=lambda n: (-found[n], n)) if found else None
    return best, round(found.get(best, 0.0), 9), len(found), sorted(found), len(words(text or ""))


def check(df, **kw):
    got = ls.license_scan(df, **kw).drop("family", "families").collect()
    want = [(r.doc_id, *brute(r.text, kw.get("templates", TEMPLATES), kw.get("threshold", ls.THRESHOLD))) for r in df.select("doc_id", "text").collect()]
    assert sorted(repr((r[0], r[1], round(r[2], 9), *r[3:])) for r in got) == sorted(map(repr, want))


def wrapped(text, width=60):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line)
            line = ""
        line = f"{line} {w}".strip()
    return "\n".join([*out, line])


def test_embedded_licences(spark):
    texts = [
        "Some text before.\n" + wrapped(TEMPLATES["MIT"]) + "\nsome text after",
        "x = 1\n# " + wrapped(TEMPLATES["Apache-2.0-notice"]).replace("\n", "\n# ") + "\nx += 1",
        "Before. Released under the MIT License. After it, more.",
        wrapped(TEMPLATES["BSD-3-Clause"]).replace("HOLDER", "OWNER"),
        "in the of the software to the use of the", "Released under the MIT", "the license", "one", "",
        "RELEASED UNDER THE MIT LICENSE!\n\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.",
        "Released\nunder\nthe\nMIT\nLicense", "Released under the é MIT License.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(df)
    got = {r.doc_id: r for r in ls.license_scan(df).collect()}
    assert [got[k].license for k in range(4)] == ["MIT", "Apache-2.0-notice", "MIT-statement", "BSD-3-Clause"]
    assert got[0].dice == got[2].dice == 1.0 and got[4].license is None and got[9].n_licenses == 2


@pytest.mark.parametrize("threshold", [0.5, 0.95])
def test_thresholds_and_odd_rows(odd_documents, threshold):
    check(odd_documents.filter("length(text) < 1000 or text is null"), threshold=threshold, templates={"a": "alpha beta gamma", "b": "kappa lambda mu nu", "c": ""})
    assert ls.license_scan(odd_documents).count() == odd_documents.count()
    assert ls.license_scan(odd_documents.limit(0)).count() == 0
    assert ls.license_scan(odd_documents, templates={}).filter("license is not null").count() == 0


def test_shared_data(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) < 1200 and text like '%icense%'")
    assert docs.count() > 3
    check(docs)
    got = ls.license_scan(table(spark, "/root/testdata/sf0.01", "documents"))
    lines = table(spark, "/root/testdata/sf0.01", "documents").filter("text like '%Released under the MIT License.%'")
    assert lines.join(got.filter("array_contains(licenses, 'MIT-statement')"), "doc_id", "left_anti").count() == 0


def test_statements_of_no_sample_table(spark):
    """Versions and variants get their own names."""
    want = {
        "Licensed under the MIT License.": "MIT", "Licensed under the Apache License 2.0.": "Apache-2.0",
        "Licensed under the terms of the MIT license.": "MIT", "The code is available under the Apache License 2.0.": "Apache-2.0",
        "Available under the MIT License.": "MIT", "SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Released under the BSD License.": "BSD",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "This project is licensed under the GPLv2.": "GPL-2.0", "Released under the BSD 2-Clause License.": "BSD-2-Clause",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 3.0 Unported License.": "CC-BY-NC-ND-3.0",
        TEMPLATES["GPL-3.0-notice"].replace("General Public", "Lesser General Public"): "LGPL-3.0",
    }
    df = spark.createDataFrame(list(enumerate(f"Before.\n{t}\nafter" for t in want)), "doc_id long, text string")
    rows = ls.license_scan(df).collect()
    got = {r.doc_id: r.family for r in rows}
    assert [got[k] for k in range(len(want))] == list(want.values())
    assert all(r.family in r.families and len(r.families) <= r.n_licenses for r in rows)


@pytest.mark.parametrize(
    "text", ["Released under the MIT License.\n" * 30, "Licensed under the\nMIT\n" * 12 + "License.\n", "a MIT License.\nReleased under\n" * 9, "the the MIT MIT License License the MIT\n" * 8]
)
def test_repeated_statements_by_brute_force(spark, text):
    check(spark.createDataFrame([(1, text), (2, "x y z.\n" + text + "License. the MIT Licensed under the")], "doc_id long, text string"))


def test_long_texts_of_repeated_statements(spark):
    """Three megabytes of one statement, and with the end of a statement far behind its beginning."""
    line = "Released under the MIT License.\n"
    texts = [line * 100_000, "Released under the MIT\n" * 100_000 + "MIT License.\n", "MIT License.\n" + "under the\n" * 200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.perf_counter()
    got = {r.doc_id: r for r in ls.license_scan(df).collect()}
    assert time.perf_counter() - began < 90
    assert got[0].family == "MIT" and got[0].dice == 1.0 and got[0].n_words == 500_000
