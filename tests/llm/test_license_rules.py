"""Licence sentences and rules against a plain version."""

import re

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from idweave.llm import license_rules as lic
from idweave.llm.oracle import ORACLES

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.
"""


def normal(s):
    return re.sub(r"[^a-z0-9]+", " ", s).strip(" ")


def sentences(text):
    """Every run of lines of every piece is tried, the longest first; what is found is used up."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    paragraphs = [[]]
    for line in folded.split("\n"):
        if normal(line):
            paragraphs[-1].append(line)
        else:
            paragraphs.append([])
    for lines in paragraphs:
        lines = [re.sub(r"^[^a-z0-9]+", "", line) for line in lines]
        for piece in re.split(r"[.!?;:](?=[\x20\x09-\x0D]|$)", "\n".join(lines)):
            left = [normal(x) for x in piece.split("\n") if normal(x)]
            while left:
                runs = [n for n in range(len(left), 0, -1) if " ".join(left[:n]) in lic.SENTENCES]
                if runs:
                    yield lic.SENTENCES[" ".join(left[: runs[0]])]
                left = left[runs[0] if runs else 1 :]


def plain(text):
    """(sequence, licences, sentences, unmatched), the rules tried on strings."""
    ids = list(sentences(text))
    rest = sequence = "".join(f"<{i}>" for i in ids)
    found = []
    for name, rule in lic.RULES:
        wanted = "".join(f"<{i}>" for i in rule)
        if wanted in rest and name not in found:
            found.append(name)
        rest = rest.replace(wanted, "<>")
    return sequence, ",".join(found), len(ids), len(re.findall("<[^>]+>", rest))


def by_sql(texts):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype="object")}))
    rows = con.sql(ORACLES["op1_license_rules"]).fetchall()
    return [r[1:] for r in sorted(rows)]


def recognised(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lic.recognise(df).orderBy("doc_id").collect()
    return [(r.sentence_ids, r.licenses, r.n_sentences, r.n_unmatched) for r in rows]


def test_every_sentence_holds_a_cue_and_is_normal():
    for s in lic.SENTENCES:
        assert s == re.sub(r"[^a-z0-9]+", " ", s.lower()).strip()
        assert any(c in s for c in lic.CUES)
    known = set(lic.SENTENCES.values())
    assert all(set(rule) <= known for _, rule in lic.RULES)


def test_longer_rules_go_first(spark):
    texts = [APACHE, "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.\nAll rights reserved.",
             "this program is FREE software; see below", None, "", "the license of nothing", "x" * 100_000 + "\nAll rights reserved."]
    got = recognised(spark, texts)
    assert got == [plain(t) for t in texts]
    assert [g[1] for g in got] == ["Apache-2.0", "Apache-2.0", "MIT,proprietary", "", "", "", "", "proprietary"]
    assert got[0][3] == 0 and got[3][2:] == (1, 1)


SENTENCE = st.sampled_from([*lic.SENTENCES, "some other words", "", "the license", "a | b"])


END = st.sampled_from([". ", ".\n{0}", "\n{0}", "\n{0}\n{0}", ": ", "\n\n", ".\r\n{0}"])
WRAPPED = st.builds(
    lambda mark, width, parts: mark + "".join(
        "".join(w + (f", \n{mark}" if n % width == 0 else " ") for n, w in enumerate(s.title().split(" "), 1)).rstrip(" ")
        + end.format(mark)
        for s, end in parts
    ),
    st.sampled_from(["", "# ", " * ", "// ", "   ", "| "]),
    st.integers(2, 20),
    st.lists(st.tuples(SENTENCE, END), max_size=6),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(WRAPPED, min_size=1, max_size=30))
def test_same_as_the_plain_version_and_sql(spark, texts):
    got = recognised(spark, texts)
    assert got == [plain(t) for t in texts]
    assert got == by_sql(texts)


def test_columns(spark):
    df = spark.createDataFrame([(None, "All rights reserved", "mine")], "doc_id long, text string, licenses string")
    (r,) = lic.recognise(df).collect()
    assert (r.doc_id, r.licenses) == (None, "proprietary")
    assert lic.recognise(df.limit(0)).collect() == []


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
APACHE_WRAPPED = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

{0}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""


def test_wrapped_originals(spark):
    texts = [MIT, APACHE_WRAPPED, GPL.format(":", ",", 3), GPL.format(";", ";", 2), BSD.format(""), BSD.format(NAMES)]
    names = ["MIT", "Apache-2.0", "GPL-3.0-or-later", "GPL-2.0-or-later", "BSD-2-Clause", "BSD-3-Clause"]
    marked = [m + t.replace("\n", "\n" + m) for t in texts for m in ("", "# ", " * ", "// ", ";; ", "| ")]
    marked += [t.replace("\n", "\r\n") for t in texts]
    got = recognised(spark, marked)
    assert [g[1] for g in got] == [n for n in names for _ in range(6)] + names
    assert all(g[3] == 0 for g in got)


def test_notices_without_a_full_stop(spark):
    texts = ["my tool\nReleased under the MIT License\nhave fun", "Released under\n\nthe MIT License", "Not released under the MIT License"]
    assert [g[1] for g in recognised(spark, texts)] == ["MIT", "", ""]


# Notices of public licences.
NOTICES = {
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "LGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify it
under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.""",
    "EPL-1.0": """All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html""",
    "EPL-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "CC0-1.0": "Released under CC0 1.0.",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.""",
}


def test_more_licences_by_their_notices(spark):
    texts = [m + t.replace("\n", "\n" + m) for t in NOTICES.values() for m in ("", "# ", " * ")]
    got = recognised(spark, texts)
    assert [g[1] for g in got] == [name for name in NOTICES for _ in range(3)]
    assert all(g[3] == 0 for g in got) and got == by_sql(texts)


def test_a_very_long_paragraph_of_lines(spark):
    text = "this software\n" * 200_000 + "All rights\nreserved"
    assert recognised(spark, [text]) == [("<all-rights>", "proprietary", 1, 0)]
