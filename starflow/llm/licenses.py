"""Licence scans by sentence rules.

A text is cut into sentences twice: once at line ends as well, and once with the lines
of a paragraph joined, as licence texts are often wrapped. A sentence is normalised
(ASCII letters in lower case, digits and ``. + / -``; all else, comment marks included,
is a blank) and mapped to the identifier of a known licence sentence. Rules are
patterns over the sequence of identifiers. Everything is one Spark projection.

Every known sentence holds one of ``KEYWORDS``; texts without any are done at once.

Defined cases: null and empty texts match nothing and give no rows; a rule that
matches in both cuttings counts the larger number; repeated rows are scanned row by
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.text import let

# Sentences of licences and licence notices, by identifier.
SENTENCES = {
    "mit-name": "MIT License",
    "mit-name-2": "The MIT License (MIT)",
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-notice-3": "This project is licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-name": "Licensed under the GNU General Public License v3.0.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-full": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-full": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-full": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-gpl3-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-bsd2": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-isc": "SPDX-License-Identifier: ISC",
}

# Sentences that name a holder, as patterns over the normalised form.
PATTERNS = {
    "copyright": r"^(all rights reserved|(the )?copyright( c)?( [0-9][0-9 -]*)?( [^ ]+){1,12})$",
    "bsd-endorse": r"^([0-9]\. )?neither the names? of .{1,120} may be used to endorse or promote products derived from this software without specific prior written permission$",
}

# (licence, rule, pattern over identifiers that each end with a blank)
COPYRIGHT = "(copyright )*"
RULES = (
    ("MIT", "text", f"(mit-name )?(mit-name-2 )?{COPYRIGHT}mit-grant mit-condition mit-as-is "),
    ("MIT", "notice", "(mit-notice|mit-notice-2|mit-notice-3|spdx-mit) "),
    ("ISC", "text", f"{COPYRIGHT}isc-grant isc-as-is "),
    ("ISC", "notice", "spdx-isc "),
    ("BSD-3-Clause", "text", f"{COPYRIGHT}bsd-grant bsd-source bsd-binary bsd-endorse bsd-as-is "),
    ("BSD-2-Clause", "text", f"{COPYRIGHT}bsd-grant bsd-source bsd-binary bsd-as-is "),
    ("BSD-3-Clause", "notice", "spdx-bsd3 "),
    ("BSD-2-Clause", "notice", "spdx-bsd2 "),
    ("Apache-2.0", "header", f"{COPYRIGHT}apache-notice apache-comply (apache-copy )?apache-as-is "),
    ("Apache-2.0", "notice", "(apache-short|spdx-apache) "),
    ("GPL-3.0", "header", f"{COPYRIGHT}gpl-free gpl-hope (gpl-details )?"),
    ("GPL-2.0", "header", f"{COPYRIGHT}gpl2-free gpl-hope (gpl-details )?"),
    ("GPL-3.0", "notice", "(gpl3-notice|gpl3-name|spdx-gpl3|spdx-gpl3-later) "),
    ("LGPL", "notice", "lgpl-details "),
    ("MPL-2.0", "notice", "mpl2-notice "),
    ("CC-BY-NC-4.0", "notice", "(cc-by-nc|cc-by-nc-full) "),
    ("CC-BY-4.0", "notice", "(cc-by|cc-by-full) "),
    ("CC-BY-SA-4.0", "notice", "(cc-by-sa|cc-by-sa-full) "),
)

KEYWORDS = "licen[cs]e|copyright|warrant|redistribut|permission|all rights reserved"
FOUND = f"(?i){KEYWORDS}"
SENTENCE_END = r"[.!?;]+[ \t\r\n]+"
LINE_CUT = rf"{SENTENCE_END}|[\r\n]+"
# A line of nothing but comment marks parts paragraphs as an empty one does.
PARAGRAPH_CUT = rf"{SENTENCE_END}|[\r\n][ \t\r#*/;-]*\n[ \t\r\n#*/;-]*"
UNWANTED = "[^A-Za-z0-9.+/-]+"
# A list mark or leading comment dashes, and what may close a sentence.
EDGES = r"^[ ./-]+|[ .]+$"


def normalise(sentence: str) -> str:
    """The Python form of the normalisation, for the table of known sentences."""
    return re.sub(EDGES, "", re.sub(UNWANTED, " ", sentence).lower())


def known_sentences() -> dict[str, str]:
    """Normalised pieces of the known sentences and the identifier of each whole one.

    A known sentence that the cutting divides is known by its last piece that holds a
    keyword; the other pieces stay unknown.
    """
    known: dict[str, str] = {}
    for name, sentence in SENTENCES.items():
        pieces = [p for p in map(normalise, re.split(SENTENCE_END, sentence)) if p]
        marked = [p for p in pieces if re.search(FOUND, p)]
        known.setdefault((marked or pieces)[-1], name)
    return known


def _identifiers(text: Column, cut: str) -> Column:
    known = known_sentences()
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    pieces = F.filter(F.split(text, cut), lambda p: F.regexp_like(p, F.lit(FOUND)))
    plain = F.transform(
        pieces, lambda p: F.regexp_replace(F.lower(F.regexp_replace(p, UNWANTED, " ")), EDGES, "")
    )

    def name(p: Column) -> Column:
        own = F.try_element_at(table, p)
        for identifier, pattern in PATTERNS.items():
            own = F.coalesce(own, F.when(F.regexp_like(p, F.lit(pattern)), F.lit(identifier)))
        return own

    names = F.filter(F.transform(plain, name), lambda x: x.isNotNull())
    return F.concat(F.array_join(names, " "), F.lit(" "))


def scan(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license, rule, n_matches: a row for each rule that a text matches."""
    some = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where(
        F.regexp_like("text", F.lit(FOUND))
    )
    sequences = some.select(
        "doc_id",
        F.array(_identifiers(F.col("text"), LINE_CUT), _identifiers(F.col("text"), PARAGRAPH_CUT)).alias("s"),
    )

    def counted(s: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(licence).alias("license"),
                    F.lit(rule).alias("rule"),
                    F.greatest(
                        *[F.regexp_count(F.get(s, F.lit(k)), F.lit(rf"\b{pattern}")) for k in (0, 1)]
                    ).cast("long").alias("n_matches"),
                )
                for licence, rule, pattern in RULES
            ]
        )

    rows = sequences.select("doc_id", F.inline(let(F.col("s"), counted)))
    return rows.where("n_matches > 0")
