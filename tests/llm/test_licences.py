import re

import pytest

from layerflow.llm import licences

DIR = "/root/testdata/sf0.01"
PLANTED = {"All rights reserved.": "proprietary", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
           "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(licences.training_prose(spark.read.parquet(f"{DIR}/documents.parquet")))


def test_planted_lines_are_found_and_prose_is_left(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = licences.op10_licences(spark, DIR).collect()
    got = {(r["doc_id"], r["paragraph"]): r for r in rows}
    want = {(d, k): PLANTED[p] for d, t in texts.items() for k, p in enumerate((t or "").split("\n")) if p in PLANTED}
    assert len(want) > 10
    for k, family in want.items():
        assert got[k]["family"] == family and got[k]["confirmed"]
    lines = {k: texts[k[0]].split("\n")[k[1]] for k in got}
    assert all(re.search("(?i)licen[sc]e|rights reserved", x) for x in lines.values()), lines
    assert all(texts[r["doc_id"]][r["start"]:].startswith(lines[r["doc_id"], r["paragraph"]]) for r in rows)


def test_held_out_notices(model):
    cases = {"It is released under the MIT License, enjoy.": "MIT", "You may use it as licensed under the Apache License Version 2.0": "Apache-2.0",
             "Text licensed under CC BY-SA 4.0 by the authors.": "CC-BY-SA", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0"}
    for text, family in cases.items():
        found = list(model.scan("plain words here\n" + text))
        assert [(f[0], f[2]) for f in found] == [(1, family)] and found[0][5], text
    own = list(model.scan("Licensed under the Sample Corporation Community License, revision 9."))
    assert own and (own[0][2] == licences.UNKNOWN and not own[0][5])
    assert list(model.scan("The weather is fine and the public garden is open.")) == []


def test_odd_rows(spark, model):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "\n\n", "x"), (2**60, "wort " * 200000 + "\nReleased under the MIT License.", "x"),
                                (None, "Released under the MIT License.", "x"), (4, "MIT", "x")], "doc_id long, text string, family string")
    rows = licences.scan(df, model).where("confirmed").collect()
    assert sorted((r["doc_id"] or 0, r["family"], r["paragraph"]) for r in rows) == [(0, "MIT", 0), (2**60, "MIT", 1)]
    empty = df.limit(0)
    assert licences.scan(empty, licences.train(licences.training_prose(empty))).count() == 0


def wrapped(text, width, mark):
    import textwrap
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# "])
@pytest.mark.parametrize("width", [40, 69, 78])
def test_wrapped_notices_are_confirmed(model, mark, width):
    for family, k in (("MIT", 3), ("BSD", 2), ("GPL-3.0", 2), ("Apache-2.0", 1)):
        notice = wrapped(licences.NOTICES[family][k], width, mark)
        text = f"int x = 1;\n\n{mark}Copyright 2020 the authors\n{mark}\n{notice}\n\nplain words here"
        found = [f for f in model.scan(text) if f[5]]
        assert [f[2] for f in found] == [family], (family, width, mark, list(model.scan(text)))
        line = text[found[0][1]:].split("\n")[0]
        assert text.split("\n")[found[0][0]] == line and line in notice.split("\n")[:2]


def test_two_wrapped_notices_and_text_between(model):
    mit, bsd = (wrapped(licences.NOTICES[f][k], 60, "# ") for f, k in (("MIT", 3), ("BSD", 2)))
    prose = "\n".join(["The weather is fine and the public garden is open to any person.", "He walked on, free of charge."] * 40)
    found = [f for f in model.scan("\n\n".join([mit, prose, bsd, prose, mit])) if f[5]]
    assert [f[2] for f in found] == ["MIT", "BSD", "MIT"]
    # an empty line between the halves: no paragraph holds the notice
    words = licences.NOTICES["MIT"][3].split()
    halves = " ".join(words[:len(words) // 2]), " ".join(words[len(words) // 2:])
    assert [f[0] for f in model.scan("\n".join(halves)) if f[5]] == [0]
    assert not [f for f in model.scan("\n \n".join(halves)) if f[5]]


def test_close_stretches_against_all_windows():
    import numpy as np
    rng = np.random.default_rng(4)
    for _ in range(300):
        keys = rng.integers(0, 6, 40)
        run = np.sort(rng.integers(0, 3, 41))
        at = np.sort(rng.choice(40, rng.integers(1, 30), replace=False))
        size, most = int(rng.integers(3, 8)), int(rng.integers(2, 15))
        want = max((len({keys[p] for p in at if i <= p <= j}) for i in at for j in at
                    if i <= j and j - i < most and run[i] == run[j]), default=0)
        got = licences._close(at, keys, run, size, most)
        assert bool(got) == (want >= licences.CONFIRM * size)
        assert all(x[2] < y[1] for x, y in zip(got, got[1:]))
        if got:
            assert max(s for s, _, _ in got) <= want
            assert all(run[i] == run[j] and j - i < most and len({keys[p] for p in at if i <= p <= j}) == s for s, i, j in got)
