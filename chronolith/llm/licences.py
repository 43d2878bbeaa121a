"""Licence recognition by sentence rules, in DataFrame functions only.

A text is cut into sentences in two ways: at line ends and at stops before white space, for notices that have a
line of their own; and at stops and blank lines only, for licences that are wrapped over lines, also inside
comments (a line without a-z or 0-9 is blank). Each sentence is normalised (A-Z lower-cased, everything but a-z
and 0-9 a blank) and looked up among known licence sentences. The text becomes, in either way, the sequence of the
identifiers found, with ``?`` for any other sentence, and rules are matched on both: a rule is a list of
identifiers that must come in order, with at most ``GAP`` other sentences between two of them.

Null and empty texts have no sentences and no licences. Repeated rows are judged each by itself. A sentence that
occurs again counts again; a licence is listed once. Other columns of the input are neither read nor returned. An
empty table gives no rows; very long texts are judged whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Sentences that a rule lets pass between two of its own.
GAP = 3

#: Identifiers of licence sentences, and the sentences as they are published.
SENTENCES = {
    "agpl.notice": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "apache.notice": ["Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'],
    "apache.copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at"],
    "apache.disclaimer": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "bsd.grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd.source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd.binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd.endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "cc.by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc.by_nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc.by_sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc.zero": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "boost.notice": ["Distributed under the Boost Software License, Version 1.0."],
    "epl2.notice": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "gpl2.notice": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl3.work": ["This work is licensed under the GNU General Public License, version 3."],
    "gpl3.notice": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl.warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "isc.grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl2.notice": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3.notice": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl.warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "mit.notice": ["Released under the MIT License.", "Licensed under the MIT License."],
    "mit.grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "mit.include": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl.notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "rights.reserved": ["All rights reserved."],
    "unlicense.grant": ["This is free and unencumbered software released into the public domain."],
    "zlib.as_is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib.grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
}

#: Licences and the sequences of sentence identifiers that show them.
RULES = {
    "agpl-3.0": [["agpl.notice"]],
    "all-rights-reserved": [["rights.reserved"]],
    "apache-2.0": [["apache.notice"], ["apache.copy", "apache.disclaimer"]],
    "bsd-2-clause": [["bsd.grant", "bsd.source", "bsd.binary"]],
    "bsd-3-clause": [["bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse"]],
    "cc-by-4.0": [["cc.by"]],
    "cc-by-nc-4.0": [["cc.by_nc"]],
    "cc-by-sa-4.0": [["cc.by_sa"]],
    "cc0-1.0": [["cc.zero"]],
    "bsl-1.0": [["boost.notice"]],
    "epl-2.0": [["epl2.notice"]],
    "gpl-2.0": [["gpl2.notice", "gpl.warranty"]],
    "gpl-3.0": [["gpl3.work"], ["gpl3.notice", "gpl.warranty"]],
    "isc": [["isc.grant"]],
    "lgpl-2.1": [["lgpl2.notice", "lgpl.warranty"]],
    "lgpl-3.0": [["lgpl3.notice", "lgpl.warranty"]],
    "mit": [["mit.notice"], ["mit.grant", "mit.include"]],
    "mpl-2.0": [["mpl.notice"]],
    "unlicense": [["unlicense.grant"]],
    "zlib": [["zlib.as_is", "zlib.grant"]],
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A break between paragraphs of lower-cased text, ends of sentences, and what normalising makes a blank (after which sentences stand on lines of their own).
BLANK = r"\n[^a-z0-9\n]*\n"
STOP, OTHER, LINE = r"[.!?]+[\x20\x09-\x0D]+|\n", r"[^a-z0-9\n]+", r" ?\n ?"


def lines_of(sentence: str) -> list[str]:
    """A sentence as the column functions below cut and normalise it (a published one may hold stops of its own)."""
    import re

    text = re.sub(STOP, "\n", sentence.lower())
    return [x.strip() for x in re.split(LINE, re.sub(OTHER, " ", text)) if x.strip()]


def table() -> dict[str, str]:
    """Identifier by normalised sentence; of a published text that is cut into several, the longest counts."""
    return {max(lines_of(s), key=len): name for name, known in SENTENCES.items() for s in known}


def pattern(rule: list[str]) -> str:
    """A rule as a regular expression on the sequence of identifiers, each with a blank after it."""
    return (r"(\S+ ){0," + str(GAP) + "}").join(x.replace(".", r"\.") + " " for x in rule)


def sentences(text: Column, wrapped: bool) -> Column:
    """Normalised sentences with a character of a-z or 0-9, in order; ``wrapped``: with lines of a paragraph joined."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    if wrapped:
        low = F.translate(F.regexp_replace(low, BLANK, ". "), "\n", " ")
    lined = F.regexp_replace(low, STOP, "\n")
    return F.filter(F.transform(F.split(F.regexp_replace(lined, OTHER, " "), LINE), lambda s: F.trim(s)), lambda s: s != "")


def recognise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_sentences, n_known, known, licences), one for each input row, without a shuffle.

    ``known``: the identifiers in order, of the way of cutting that finds more (lines if equal); ``licences``:
    those whose rules match in either, in order; both joined by a blank. n_sentences counts those by lines.
    """
    known = F.create_map(*(F.lit(x) for kv in table().items() for x in kv))
    ids = lambda wrapped: F.transform(sentences(F.col(text), wrapped), lambda s: F.coalesce(F.try_element_at(known, s), F.lit("?")))
    found = docs.select(F.col(doc_id), ids(False).alias("a"), ids(True).alias("b"))
    of = lambda c: F.filter(c, lambda x: x != "?")
    seq = found.select(doc_id, F.size("a").cast("bigint").alias("n_sentences"), of("a").alias("k"), of("b").alias("w"), F.concat(F.array_join("a", " "), F.lit(" / / / / "), F.array_join("b", " "), F.lit(" ")).alias("seq"))
    seq = seq.withColumn("k", F.when(F.size("w") > F.size("k"), F.col("w")).otherwise(F.col("k")))
    hits = [
        F.when(F.size("k") > 0, F.when(F.expr(" OR ".join(f"rlike(seq, r'(^| ){pattern(r)}')" for r in rules)), F.lit(name)))
        for name, rules in RULES.items()
    ]
    return seq.select(doc_id, "n_sentences", F.size("k").cast("bigint").alias("n_known"), F.array_join("k", " ").alias("known"), F.concat_ws(" ", *hits).alias("licences"))


def oracle(table_name: str = "documents") -> str:
    """The same over a DuckDB view with doc_id and text."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = "map([" + ", ".join(map(quote, table())) + "], [" + ", ".join(map(quote, table().values())) + "])"
    hits = ", ".join("CASE WHEN " + " OR ".join(f"regexp_matches(seq, {quote('(^| )' + pattern(r))})" for r in rules) + f" THEN {quote(name)} END" for name, rules in RULES.items())
    cut = lambda c: f"list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace({c}, '{STOP}', chr(10), 'g'), '{OTHER}', ' ', 'g'), '{LINE}'), lambda x: trim(x)), lambda x: x <> '')"
    ids = lambda c: f"list_transform({c}, lambda x: coalesce({known}[x], '?'))"
    return rf"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM {table_name}),
s AS (SELECT doc_id, {cut("low")} AS sa, {cut(f"replace(regexp_replace(low, '{BLANK}', '. ', 'g'), chr(10), ' ')")} AS sb FROM t),
i AS (SELECT doc_id, {ids("sa")} AS a, {ids("sb")} AS b FROM s),
p AS (SELECT doc_id, len(a)::BIGINT AS n_sentences, list_filter(a, lambda x: x <> '?') AS ka, list_filter(b, lambda x: x <> '?') AS kb,
      array_to_string(a, ' ') || ' / / / / ' || array_to_string(b, ' ') || ' ' AS seq FROM i),
q AS (SELECT doc_id, n_sentences, CASE WHEN len(kb) > len(ka) THEN kb ELSE ka END AS k, seq FROM p)
SELECT doc_id, n_sentences, len(k)::BIGINT AS n_known, array_to_string(k, ' ') AS known, concat_ws(' ', {hits}) AS licences FROM q"""
