"""Licence and secret scans on published texts and on texts with very many matches."""

from __future__ import annotations

import random
import re

import pytest

from tidewater.llm import licenses, secrets

S = licenses.SENTENCES
HOLDER = "Neither the name of Some One, Inc. and its friends nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD = f"Copyright (c) 2020, Some One\nAll rights reserved.\n\n{S['bsd-grant']}:\n\n1. {S['bsd-source']}.\n\n2. {S['bsd-binary']}.\n"
NAMED = {
    "BSD-2-Clause": f"BSD 2-Clause License\n\n{BSD}",
    "BSD-3-Clause": f"{BSD}\n3. {HOLDER.replace(', Inc.', '')}\n\nTHIS SOFTWARE IS PROVIDED BY SOME ONE",
    "BSD-4-Clause": f"{BSD}\n3. {S['bsd-advertising']}:\n   This product includes software.\n\n4. {HOLDER.replace(', Inc.', '')}\n",
    "NCSA": f"{S['ncsa-grant']}:\n\n* {S['bsd-source']}s.\n\n* {S['bsd-binary']}.\n",
    "MIT-0": f"{S['mit-0-grant']}.\n\n{S['mit-warranty']}. {S['mit-liability']}.",
    "0BSD": f"{S['0bsd-grant']}.\n",
    "ISC": f"ISC License\n\n{S['isc-grant']}.\n",
    "Zlib": f"{S['zlib-grant']}:\n\n1. {S['zlib-origin']}; you must not claim that you wrote the original software. If you use it, thank us.\n2. {S['zlib-altered']}.\n",
    "Unlicense": f"{S['unlicense-domain']}.\n\n{S['unlicense-grant']}.\n",
    "EPL-2.0": f"{S['epl2'].replace('http:', 'https:')}/\n\nContributors",
    "LGPL-2.1-or-later": f" * {S['lgpl21-or-later'].replace(' under ', chr(10) + ' * under ')}.\n",
    "AGPL-3.0-or-later": f"{S['agpl3-or-later']}.",
    "GPL-3.0": f"                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. Everyone may copy.\n\nPreamble\n\n  {S['gpl3-preamble']}.\n",
    "Apache-2.0": f"   Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n   {S['apache-heading']}\n\n   1. Definitions.\n\n  {S['apache-definition']}.\n",
    "CC-BY-SA-4.0": f"{S['cc-by-sa-4']}.",
}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_the_longest_rule_names_the_licence(spark):
    names = list(NAMED)
    got = by_id(licenses.scan(spark.createDataFrame(list(enumerate(NAMED.values())), "doc_id long, text string")))
    assert [got[k].licences for k in range(len(names))] == names
    three = got[names.index("BSD-3-Clause")]
    assert three.rules == "bsd-3-text,bsd-text" and three.n_known == 4
    assert len({licence for _, licence, _ in licenses.RULES}) >= 25
    assert all(re.search(licenses.KEYWORDS, s) for s in S.values())


def test_licences_that_follow_each_other_are_all_named(spark):
    text = f"{NAMED['BSD-3-Clause']}.\n\n{NAMED['BSD-2-Clause']}\n\n{NAMED['0BSD']}"
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.licences == "0BSD,BSD-2-Clause,BSD-3-Clause"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 255, 256, 257, 20_000])
def test_tokens_in_base_spans_are_found_among_many(spark, n):
    """Hex tokens are base spans, so only mixed tokens are left for entropy, wherever they stand."""
    r = random.Random(n)
    token = lambda letters: "".join(r.choice(letters) for _ in range(32))
    tokens = [token("0123456789abcdef") if r.random() < 0.7 else "Zq9" + token("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n)]
    text = " ".join(tokens)
    (row,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    at, spans = 0, []
    for t in tokens:
        spans += [("hex", at, at + 32)] if t[:3] != "Zq9" else []
        at += len(t) + 1
    found = [s.split(":") for s in row.spans.split(",") if s]
    assert [(k, int(a), int(b)) for k, a, b in found if k == "hex"] == spans
    entropy = [(int(a), int(b)) for k, a, b in found if k == "entropy"]
    assert row.n_entropy == len(entropy) and (n < 100 or entropy)
    assert all(text[a:b] in "".join(tokens) and not re.fullmatch("[0-9a-f]+", text[a:b]) for a, b in entropy)
