"""Licence recognition by sentence rules, with DataFrame functions only.

A text is cut into sentences; each is normalised and, if it is a known licence sentence, named. The
names in order, with a mark for every unknown sentence, are held against rules, ordered sequences
of names: a rule is met where its names follow each other with at most ``GAP`` unknown sentences
between two of them, such as numbers of clauses, addresses and copyright lines. Where rules share a
stretch, the one with most sentences says which licence it is.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences of public licences and notices.
SENTENCES = {
    "mit-ref": "Released under the MIT License",
    "mit-ref-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-short": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "apache-ref": "Licensed under the Apache License, Version 2.0",
    "apache-terms": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-may-not": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-at": "You may obtain a copy of the License at",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-warranty": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-nc-4-ref": "Licensed under CC BY-NC 4.0",
    "cc-by-4-ref": "Licensed under CC BY 4.0",
    "cc-by-sa-4-ref": "Licensed under CC BY-SA 4.0",
    "cc0": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl3-preamble": "The GNU General Public License is a free, copyleft license for software and other kinds of works",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl2-preamble": "This General Public License applies to most of the Free Software Foundation's software and to any other program whose authors commit to using it",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl3-supplement": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below",
    "lgpl3-or-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl21-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl-see": "See the GNU Lesser General Public License for more details",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "agpl3-preamble": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software",
    "agpl3-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "apache-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "apache-heading": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "apache-definition": "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document",
    "mit-0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "ncsa-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "bsd-2-title": "BSD 2-Clause License",
    "bsd-3-title": "BSD 3-Clause License",
    "bsd-3-ref": "Licensed under the BSD 3-Clause License",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "isc-title": "ISC License",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-origin": "The origin of this software must not be misrepresented",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software",
    "unlicense-domain": "This is free and unencumbered software released into the public domain",
    "unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl-ref": "Distributed under the Boost Software License, Version 1.0",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    "epl1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "mpl11": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")",
    "cddl": "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\")",
    "artistic2": "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed",
    "ofl": "This Font Software is licensed under the SIL Open Font License, Version 1.1",
    "postgresql": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "psf2-title": "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2",
    "mspl-title": "Microsoft Public License (Ms-PL)",
    "cc-by-nd-4-ref": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa-4-ref": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nc-nd-4-ref": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-4": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nd-4": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-nc-sa-4": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nc-nd-4": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
}
#: Rules: name, licence, sentences in order.
RULES = (
    ("mit-text", "MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("mit-grant", "MIT", ("mit-grant",)),
    ("mit-title", "MIT", ("mit-title",)),
    ("mit-title-short", "MIT", ("mit-title-short",)),
    ("mit-ref", "MIT", ("mit-ref",)),
    ("mit-ref-licensed", "MIT", ("mit-ref-licensed",)),
    ("apache-notice", "Apache-2.0", ("apache-terms", "apache-may-not", "apache-copy", "apache-warranty", "apache-see")),
    ("apache-notice-file", "Apache-2.0", ("apache-terms", "apache-may-not", "apache-copy-at", "apache-warranty", "apache-see")),
    ("apache-terms", "Apache-2.0", ("apache-terms", "apache-may-not")),
    ("apache-ref", "Apache-2.0", ("apache-ref",)),
    ("gpl3-ref", "GPL-3.0", ("gpl3-ref",)),
    ("gpl3-notice", "GPL-3.0-or-later", ("gpl3-or-later",)),
    ("gpl2-notice", "GPL-2.0-or-later", ("gpl2-or-later",)),
    ("bsd-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("isc-text", "ISC", ("isc-grant",)),
    ("mpl2-notice", "MPL-2.0", ("mpl2",)),
    ("cc-by-nc-4-ref", "CC-BY-NC-4.0", ("cc-by-nc-4-ref",)),
    ("cc-by-4-ref", "CC-BY-4.0", ("cc-by-4-ref",)),
    ("cc-by-sa-4-ref", "CC-BY-SA-4.0", ("cc-by-sa-4-ref",)),
    ("cc0-deed", "CC0-1.0", ("cc0",)),
    ("gpl3-title", "GPL-3.0", ("gpl3-title",)),
    ("gpl3-text", "GPL-3.0", ("gpl3-title", "gpl3-preamble")),
    ("gpl2-title", "GPL-2.0", ("gpl2-title",)),
    ("gpl2-preamble", "GPL-2.0", ("gpl2-preamble",)),
    ("gpl2-only-notice", "GPL-2.0-only", ("gpl2-only",)),
    ("lgpl3-title", "LGPL-3.0", ("lgpl3-title",)),
    ("lgpl3-text", "LGPL-3.0", ("lgpl3-title", "lgpl3-supplement")),
    ("lgpl3-notice", "LGPL-3.0-or-later", ("lgpl3-or-later",)),
    ("lgpl21-title", "LGPL-2.1", ("lgpl21-title",)),
    ("lgpl21-notice", "LGPL-2.1-or-later", ("lgpl21-or-later",)),
    ("agpl3-title", "AGPL-3.0", ("agpl3-title",)),
    ("agpl3-text", "AGPL-3.0", ("agpl3-title", "agpl3-preamble")),
    ("agpl3-notice", "AGPL-3.0-or-later", ("agpl3-or-later",)),
    ("apache-title", "Apache-2.0", ("apache-title",)),
    ("apache-text", "Apache-2.0", ("apache-title", "apache-heading", "apache-definition")),
    ("mit-0-text", "MIT-0", ("mit-0-grant", "mit-warranty", "mit-liability")),
    ("ncsa-text", "NCSA", ("ncsa-grant", "bsd-source", "bsd-binary")),
    ("ncsa-grant", "NCSA", ("ncsa-grant",)),
    ("bsd-2-title", "BSD-2-Clause", ("bsd-2-title",)),
    ("bsd-3-title", "BSD-3-Clause", ("bsd-3-title",)),
    ("bsd-3-ref", "BSD-3-Clause", ("bsd-3-ref",)),
    ("bsd-3-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("bsd-4-text", "BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse")),
    ("isc-title", "ISC", ("isc-title",)),
    ("0bsd-text", "0BSD", ("0bsd-grant",)),
    ("zlib-text", "Zlib", ("zlib-grant", "zlib-origin", "zlib-altered")),
    ("unlicense-text", "Unlicense", ("unlicense-domain", "unlicense-grant")),
    ("unlicense-domain", "Unlicense", ("unlicense-domain",)),
    ("bsl-title", "BSL-1.0", ("bsl-title",)),
    ("bsl-ref", "BSL-1.0", ("bsl-ref",)),
    ("epl2-notice", "EPL-2.0", ("epl2",)),
    ("epl1-notice", "EPL-1.0", ("epl1",)),
    ("mpl11-notice", "MPL-1.1", ("mpl11",)),
    ("cddl-notice", "CDDL-1.0", ("cddl",)),
    ("artistic2-preamble", "Artistic-2.0", ("artistic2",)),
    ("ofl-notice", "OFL-1.1", ("ofl",)),
    ("postgresql-text", "PostgreSQL", ("postgresql",)),
    ("psf2-title", "PSF-2.0", ("psf2-title",)),
    ("mspl-title", "MS-PL", ("mspl-title",)),
    ("cc-by-nd-4-ref", "CC-BY-ND-4.0", ("cc-by-nd-4-ref",)),
    ("cc-by-nc-sa-4-ref", "CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-ref",)),
    ("cc-by-nc-nd-4-ref", "CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-ref",)),
    ("cc-by-4", "CC-BY-4.0", ("cc-by-4",)),
    ("cc-by-sa-4", "CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("cc-by-nc-4", "CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("cc-by-nd-4", "CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("cc-by-nc-sa-4", "CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("cc-by-nc-nd-4", "CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
)
#: Every known sentence holds one of these, so a text without them needs no sentences.
KEYWORDS = r"(?i)licen|permi|redistribut|copyright|warrant|misrepresent|public domain|advertising materials|terms and conditions|distribute this software"
END = r"[.;:!?]+([\x20\x09-\x0D]|\z)|\n[\x20\x09*#/-]*\n"
GAP = 3
UNKNOWN = "?"


#: In normalised sentences, what differs from file to file, and what stands for it.
FILLS = (
    (r"\bhttps www ", "http www "),
    (r"^neither the names? of .+ nor the names? of (its|any|other) contributors may ", "neither the name of the copyright holder nor the names of its contributors may "),
)


def normal(sentence: str) -> str:
    """Lower-case ASCII letters and digits, all else as single blanks, with names of holders as ``FILLS`` has them."""
    plain = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), sentence)).strip()
    return reduce(lambda t, fill: re.sub(*fill, t), FILLS, plain)


def _normal(sentence: Column) -> Column:
    ascii_lower = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.trim(F.regexp_replace(ascii_lower, "[^a-z0-9]+", " "))
    return reduce(lambda t, fill: F.regexp_replace(t, *fill), FILLS, plain)


def _parts(sentence: str) -> list[str]:
    """A known sentence with ends inside counts as the sentences it falls into."""
    return [p for p in map(normal, re.split(r"[.;:!?]+(?=[\x20\x09-\x0D]|\Z)", sentence)) if p]


def _table() -> tuple[dict[str, str], list[tuple[str, str, str]], str, dict[str, str]]:
    """Names by normalised sentence, rules with their sequence as a pattern, a pattern of stretches with the longest rule first, and licences by stretch."""
    names: dict[str, str] = {}
    whole: dict[str, list[str]] = {}
    for name, sentence in SENTENCES.items():
        parts = _parts(sentence)
        whole[name] = [names.setdefault(p, name if len(parts) == 1 else f"{name}-{k}") for k, p in enumerate(parts)]
    between = rf",(\?,){{0,{GAP}}}"
    flat = [(rule, licence, [n for s in sequence for n in whole[s]]) for rule, licence, sequence in RULES]
    rules = [(rule, licence, "," + between.join(ids) + ",") for rule, licence, ids in flat]
    longest = sorted((ids for _, _, ids in flat), key=len, reverse=True)
    stretch = "|".join(rf"(?:<\?>){{0,{GAP}}}".join(f"<{n}>" for n in ids) for ids in longest)
    return names, rules, stretch, {"".join(f"<{n}>" for n in ids): licence for _, licence, ids in flat}


NAMES, SEQUENCES, STRETCH, LICENCES = _table()


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_known, sentence_ids, rules, licences), one row a row of ``docs``.

    n_known counts sentences that are known, sentence_ids lists them in order, rules all that match,
    sorted, each once; all lists are comma-joined. licences are those of the longest rules: from the first
    sentence on, the rule with most sentences takes its stretch and the search goes on behind it, so what
    is part of a longer licence isn't named for itself. A sentence ends with
    . ; : ! or ? before white space or the text's end, or at a blank line; one that isn't known as a whole is tried by
    its last line. Null and empty texts have none: 0 and empty strings; repeated rows and ids each
    count for themselves, and a text may be of any length.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sentences = F.split(F.regexp_replace(text, END, "\u0001$1"), "\u0001", -1)
    known = F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))

    def name(sentence):
        whole = F.element_at(known, _normal(sentence))
        return F.coalesce(whole, F.element_at(known, _normal(F.substring_index(sentence, "\n", -1))), F.lit(UNKNOWN))

    # The blanks that white space leaves behind the last end aren't a sentence.
    named = F.transform(F.filter(sentences, lambda s: F.trim(F.translate(s, "\t\n\u000b\f\r", "     ")) != ""), name)
    named = F.when(text.rlike(KEYWORDS), named).otherwise(F.array().cast("array<string>"))
    found = docs.select("doc_id", named.alias("named"))
    found = found.withColumn("sequence", F.concat(F.lit(","), F.concat_ws(",", "named"), F.lit(",")))
    ids = F.filter("named", lambda n: n != UNKNOWN)
    met = [F.when(F.col("sequence").rlike(sequence), F.lit(rule)) for rule, _, sequence in SEQUENCES]
    stretches = F.regexp_extract_all(F.concat(F.lit("<"), F.concat_ws("><", "named"), F.lit(">")), F.lit(STRETCH), F.lit(0))
    licence = F.create_map(*(F.lit(x) for pair in LICENCES.items() for x in pair))
    licences = F.transform(stretches, lambda s: F.element_at(licence, F.replace(s, F.lit(f"<{UNKNOWN}>"), F.lit(""))))
    listed = lambda values: F.concat_ws(",", F.array_sort(F.array_distinct(values)))
    return found.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_known"),
        F.concat_ws(",", ids).alias("sentence_ids"),
        listed(F.array_compact(F.array(*met))).alias("rules"),
        listed(licences).alias("licences"),
    )
