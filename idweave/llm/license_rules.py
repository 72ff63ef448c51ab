"""Licence recognition by sentences and ordered rules.

A paragraph ends at a line that holds nothing but comment marks; marks that lead a line
are dropped. Inside it the text is cut after ``. ! ? ; :`` before white space or a line
end. A sentence may be wrapped over lines; a line, or several in a row, that make a known
sentence count without a full stop too, the longest one first. Sentences are normalised:
A-Z folded, every run of other characters than a-z and 0-9 a space. A normalised sentence
is looked up in a map from sentence to identifier; unknown ones are dropped, and what is
left is the document's identifier sequence in order of reading. The rules are then tried
in their order: where the sequence holds a rule's identifiers one after the other, the
licence is found and those identifiers are used up, so a longer rule goes before the
shorter ones it contains.

Texts are normalised by built-in functions; only those with one of the words that every
known sentence holds one of go to Python, in Arrow batches. Runs of lines are looked up
where their first word and number of words are those of a known sentence, so the work
grows with the text and not with the table. No shuffle; the tables are constants.

Defined cases: null and empty text have no sentences; a sentence occurring twice is
there twice; null or repeated doc_id changes nothing; extra columns pass through, those
named like the added ones are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDED = ("sentence_ids", "licenses", "n_sentences", "n_unmatched")

# Normalised sentences of public licence texts and notices.
SENTENCES: dict[str, str] = {
    "licensed under the apache license version 2 0": "apache-2-notice",
    "licensed under the apache license version 2 0 the license": "apache-2-notice",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-limits",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice-kept",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-terms",
    "either version 2 of the license or at your option any later version": "gpl-2-later",
    "either version 3 of the license or at your option any later version": "gpl-3-later",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed": "bsd-as-is",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
    "licensed under cc by nc 4 0": "cc-by-nc-4-notice",
    "licensed under cc by 4 0": "cc-by-4-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-4-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4-notice",
    "all rights reserved": "all-rights",
    "this library is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl-2-only-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl-2-1-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-terms",
    "either version 2 1 of the license or at your option any later version": "gpl-2-1-later",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "agpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl-3-terms",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-terms",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl-2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-2-copy",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl-1-notice",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl-2-notice",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which accompanies this distribution and is available at https www eclipse org legal epl 2 0": "epl-2-notice",
    "licensed under cc0 1 0": "cc0-notice",
    "released under cc0 1 0": "cc0-notice",
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law": "cc0-notice",
    "this software is provided as is without any express or implied warranty": "zlib-as-is",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liable",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "the origin of this software must not be misrepresented": "zlib-origin",
}

# Licences and the identifier sequences that state them, in order of trial.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-2-notice", "apache-comply", "apache-copy", "apache-as-is", "apache-limits")),
    ("Apache-2.0", ("apache-2-notice", "apache-comply", "apache-as-is", "apache-limits")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("MIT", ("mit-notice", "mit-grant", "mit-notice-kept", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice-kept", "mit-as-is")),
    ("MIT", ("mit-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-terms")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "gpl-3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "gpl-2-later")),
    ("GPL-2.0-only", ("gpl-free", "gpl-2-only-terms")),
    ("GPL-3.0", ("gpl-3-notice",)),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl-3-terms")),
    ("LGPL-2.1-or-later", ("gpl-free", "lgpl-2-1-terms")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl-terms", "gpl-3-later")),
    ("LGPL-2.1-or-later", ("gpl-free", "lgpl-terms", "gpl-2-1-later")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-terms", "gpl-3-later")),
    ("MPL-2.0", ("mpl-terms", "mpl-2-copy")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("0BSD", ("0bsd-grant", "isc-as-is")),
    ("Unlicense", ("unlicense-notice", "unlicense-grant")),
    ("Unlicense", ("unlicense-notice",)),
    ("EPL-1.0", ("all-rights", "epl-1-notice")),
    ("EPL-1.0", ("epl-1-notice",)),
    ("EPL-2.0", ("all-rights", "epl-2-notice")),
    ("EPL-2.0", ("epl-2-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant", "zlib-origin")),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    ("CC-BY-4.0", ("cc-by-4-notice",)),
    ("proprietary", ("all-rights",)),
]

#: Every known sentence holds one of these.
CUES = ("license", "licensed", "rights", "permission", "software", "redistribution", "redistributions", "mpl", "cc0")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SENTENCE_END = "[.!?;:](?=[\\x20\\x09-\\x0D]|$)"

#: By first word: numbers of words of the known sentences, largest first.
WORD_COUNTS: dict[str, list[int]] = {
    first: sorted({s.count(" ") + 1 for s in SENTENCES if s.split(" ", 1)[0] == first}, reverse=True)
    for first in {s.split(" ", 1)[0] for s in SENTENCES}
}


def _pieces(folded: Column) -> Column:
    """The normalised text with line ends kept and a | where a sentence or paragraph ends."""
    text = F.translate(folded, "|", " ")
    text = F.regexp_replace(text, "(?<![^\\n])[^a-z0-9\\n]+", "")
    text = F.regexp_replace(F.regexp_replace(text, "\\n\\n+", "|"), _SENTENCE_END, "|")
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z0-9\\n|]+", " "), " ?([\\n|]) ?", "$1"))


def _identifiers(pieces: str) -> list[str]:
    """The identifiers of the known sentences, in order of reading."""
    found = []
    for piece in pieces.split("|"):
        lines = [line for line in piece.split("\n") if line]
        before = list(accumulate((line.count(" ") + 1 for line in lines), initial=0))
        line_at = {words: i for i, words in enumerate(before)}
        i = 0
        while i < len(lines):
            after = i + 1
            for n in WORD_COUNTS.get(lines[i].split(" ", 1)[0], ()):
                end = line_at.get(before[i] + n)
                known = end and SENTENCES.get(" ".join(lines[i:end]))
                if known:
                    found.append(known)
                    after = end
                    break
            i = after
    return found


def _licences(ids: list[str]) -> tuple[list[str], int]:
    """The licences found, each once in the order of the rules, and the number of unused identifiers."""
    names: list[str] = []
    rest: list[str | None] = list(ids)
    present = set(ids)
    for name, rule in RULES:
        if not present.issuperset(rule):
            continue
        i = 0
        while i + len(rule) <= len(rest):
            if tuple(rest[i : i + len(rule)]) == rule:
                rest[i : i + len(rule)] = [None]
                if name not in names:
                    names.append(name)
            i += 1
    return names, sum(x is not None for x in rest)


def recognise(docs: DataFrame) -> DataFrame:
    """``docs`` with sentence_ids, licenses, n_sentences and n_unmatched.

    sentence_ids: the sequence, as ``<id><id>``. licenses: the licences found, in the
    order of the rules, each once, joined by commas; empty if there are none.
    """

    @F.pandas_udf("sentence_ids string, licenses string, n_sentences long, n_unmatched long")
    def found(pieces: pd.Series) -> pd.DataFrame:
        rows = []
        for text in pieces:
            ids = _identifiers(text) if text else []
            names, unused = _licences(ids) if ids else ([], 0)
            rows.append(("".join(f"<{i}>" for i in ids), ",".join(names), len(ids), unused))
        return pd.DataFrame(rows, columns=list(ADDED))

    base = docs.drop(*ADDED)
    worth = F.col("text").rlike("(?i)" + "|".join(CUES))
    pieces = F.when(worth, _pieces(F.translate("text", UPPER, LOWER)))
    out = base.withColumn("__found", found(pieces))
    return out.select(*base.columns, *(F.col("__found")[c].alias(c) for c in ADDED))
