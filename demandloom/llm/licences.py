"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, equivalent spellings made equal, copyright lines dropped, everything but
letters and digits turned into single blanks. The digest of the canonical form is looked up in a table of known licence
texts and notices: full standard texts (files in `licence_texts`, and short ones below) and notices made of every name of a
licence in the usual sentences. Entire texts are compared: the whole document, and each of its lines as a text of its own, so a
notice line inside a document counts while a licence quoted in the middle of a line does not.

All steps are DataFrame functions. The known table is broadcast only while its count is checked to be small; a larger one
is joined by shuffling digests.

Defined cases: null or empty texts, and texts without a letter or digit, match nothing; a document that repeats a notice
gets one row per line; repeated rows are scanned one by one; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import functools
import operator
import re
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A known table up to this many rows (at most about 100 bytes each) is broadcast.
BROADCAST_ROWS = 100_000

# Words that licence guidelines treat as equal, written form first.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sublicence", "sublicense"), ("sub license", "sublicense"), ("sub licence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("behaviour", "behavior"), ("centre", "center"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("judgement", "judgment"), ("labour", "labor"),
    ("modelled", "modeled"), ("noncommercial", "non commercial"),
    ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("recognised", "recognized"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("copyright holder", "copyright owner"), ("copyright holders", "copyright owners"), ("http", "https"),
)

# Short licence texts and single notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_SHORT = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."), ("ISC", "Licensed under the ISC License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.
"""
#: Names of the licences in notices; those that read "the ..." first.
NAMES = {
    "MIT": (("MIT License", "MIT Licence (MIT)"), ("MIT",)),
    "ISC": (("ISC License",), ("ISC",)),
    "BSD-2-Clause": (("BSD 2-Clause License", "2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"), ("BSD-2-Clause",)),
    "BSD-3-Clause": (
        ("BSD 3-Clause License", "3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License"),
        ("BSD-3-Clause",),
    ),
    "Apache-2.0": (
        ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2 License", "Apache License 2"),
        ("Apache-2.0", "Apache 2"),
    ),
    "CC0-1.0": (("Creative Commons CC0 1.0 Universal License",), ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal")),
    "Artistic-1.0-Perl": (("Artistic License",), ("Artistic-1.0-Perl",)),
    "Unlicense": (("Unlicense",), ("Unlicense",)),
} | {
    f"MPL-{v}": (
        (f"Mozilla Public License, version {v}", f"Mozilla Public License {v}", f"Mozilla Public License v{v}", f"MPL {v}"), (f"MPL-{v}",),
    )
    for v in ("1.1", "2.0")
} | {
    f"{short}-{v}{'-or-later' if later else ''}": (
        tuple(
            name + later
            for n in dict.fromkeys((v, v.removesuffix(".0")))
            for name in (
                f"GNU {long} License, version {n}", f"GNU {long} License v{n}", f"GNU {short} v{n}", f"GNU {short}v{n}", f"{short}v{n}", f"{short} {n}",
            )
        ),
        (f"{short}-{v}-or-later",) if later else (f"{short}-{v}", f"{short}-{v}-only"),
    )
    for short, long, versions in (
        ("GPL", "General Public", ("1.0", "2.0", "3.0")), ("LGPL", "Library General Public", ("2.0",)),
        ("LGPL", "Lesser General Public", ("2.1", "3.0")), ("AGPL", "Affero General Public", ("3.0",)),
        ("GFDL", "Free Documentation", ("1.2", "1.3")),
    )
    for v in versions for later in ("", " or later")
} | {
    f"CC-BY{kind}-{v}": (
        (f"Creative Commons Attribution{words} {v} {area} License", f"Creative Commons Attribution{words} {v} License"),
        (f"CC BY{kind} {v}", f"Creative Commons Attribution{words} {v} {area}"),
    )
    for kind, words in (
        ("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"),
        ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"),
    )
    for v, area in (("3.0", "Unported"), ("4.0", "International"))
}
_VERBS = ("licensed under", "released under", "distributed under", "available under")
_WORKS = ("work", "software", "project", "program", "library", "package", "code", "file", "document")
_TERMS = ("", "the terms of ")


def notices() -> list[tuple[str, str]]:
    """Every name of a licence in the usual sentences."""
    out = []
    for licence, (named, bare) in NAMES.items():
        for name in dict.fromkeys((*(f"the {n}" for n in named), *named, *bare)):
            for verb in _VERBS:
                for terms in _TERMS:
                    out.append((licence, f"{verb} {terms}{name}."))
                    out += [(licence, f"This {work} is {verb} {terms}{name}.") for work in _WORKS]
            out += [(licence, f"{head}: {name}") for head in ("License", "SPDX-License-Identifier")]
    return out


def full_texts() -> list[tuple[str, str]]:
    """The standard texts, those with an appendix also without it, and the notices that they recommend."""
    out = []
    for file in sorted(resources.files("demandloom.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        if not file.name.endswith(".txt"):
            continue
        licence, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        out.append((licence, text))
        body = re.search(r"(?s)^.*END OF TERMS AND CONDITIONS", text)
        if body:
            out += [(licence, body[0]), (licence, body[0].removesuffix("END OF TERMS AND CONDITIONS"))]
        for notice in (
            r"Licensed under the Apache License.*?limitations under the License\.",
            r"This (?:program|library) is free software.*?(?:USA\.?|licenses/>\.)\n", r"This Source Code Form is subject.*?/MPL/2\.0/\.",
        ):
            # only GNU notices name a later version
            later = "-or-later" if "free software" in notice else ""
            out += [(licence + later, m[0]) for m in re.finditer(f"(?s){notice}", text[len(body[0]) if body else 0:])]
    for licence, third, name in (("BSD-2-Clause", "", "BSD 2-Clause License\n"), ("BSD-3-Clause", _BSD_THIRD, "BSD 3-Clause License\n")):
        numbered = _BSD_START + third + _BSD_END
        for text in (numbered, re.sub(r"(?m)^\d\. ", "* ", numbered)):
            out += [(licence, text), (licence, name + text)]
    return out


KNOWN = tuple(dict.fromkeys((*_SHORT, *full_texts(), *notices())))


#: Spellings change the length of a text by this factor at most.
STRETCH = max(max(len(a) / len(b), len(b) / len(a)) for a, b in SPELLINGS)
#: Spellings leave so many first letters of a text as they are; more different beginnings than this are not told apart.
HEAD = min(next(k for k in range(len(a) + 1) if a[k: k + 1] != b[k: k + 1]) for a, b in SPELLINGS)
HEADS = 300
#: A copyright line: optional signs, then the word or sign and anything behind it.
COPYRIGHT = r"(?s)^[^\p{L}\p{N}(©]*(copyright\b(?! (notice|holder|owner)).*|\(c\).*|©.*|all rights reserved[. ]*)$"


def stripped(line: Column) -> Column:
    """A line in lower case, letters and digits only, single blanks between words; empty for a copyright line."""
    line = F.lower(line)
    named = F.contains(line, F.lit("copyright")) | F.contains(line, F.lit("(c)")) | F.contains(line, F.lit("©"))
    named |= F.contains(line, F.lit("all rights reserved"))
    words = F.trim(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " "))
    return F.when(named & line.rlike(COPYRIGHT), F.lit("")).otherwise(words)


def respelled(words: Column) -> Column:
    """Equivalent spellings made equal."""
    # two blanks between words, so that neighbours can both be replaced
    text = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for written, used in SPELLINGS:
        text = F.replace(text, F.lit(f" {written.replace(' ', '  ')} "), F.lit(f" {used.replace(' ', '  ')} "))
    return F.trim(text)


def units(texts: DataFrame) -> DataFrame:
    """id, line (null for the whole), words: the stripped form of each line and of the text that the lines make."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), stripped)
    texts = texts.select("id", lines.alias("lines"))
    whole = F.struct(
        F.lit(None).cast("int").alias("line"), F.array_join(F.filter("lines", lambda s: s != ""), " ").alias("words")
    )
    each = F.transform("lines", lambda s, k: F.struct(k.alias("line"), s.alias("words")))
    return texts.select("id", F.when(F.size("lines") > 1, F.concat(each, F.array(whole))).otherwise(each).alias("units"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, line (null for the whole document), licence and digest of every entire text that is a known one.

    A text whose first letters and stripped length no known text can have, spellings considered, is left out before it is
    respelled.
    """
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(KNOWN, "licence string, known_text string")
    forms = units(known.select(F.col("licence").alias("id"), F.col("known_text").alias("text")))
    forms = forms.select("id", respelled(F.element_at("units", -1)["words"]).alias("form")).where("form <> ''")
    table = forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("id").alias("licence"))
    size = forms.agg(F.count("*"), F.min(F.length("form")), F.max(F.length("form"))).first()
    if size[0] <= BROADCAST_ROWS:
        table = F.broadcast(table)
    least, most = (size[1] or 1) / STRETCH, (size[2] or 0) * STRETCH
    heads = forms.groupBy(F.substring("form", 1, HEAD).alias("head")).agg(F.min(F.length("form")), F.max(F.length("form")))
    heads = sorted(heads.limit(HEADS + 1).collect())

    def likely(words: Column) -> Column:
        length, fits = F.length(words), F.lit(True)
        if 0 < len(heads) <= HEADS:
            fits = functools.reduce(operator.or_, (
                (F.substring(words, 1, HEAD) == h) & length.between(low / STRETCH, high * STRETCH) for h, low, high in heads
            ))
        return length.between(least, most) & fits

    found = units(docs.select(F.col("doc_id").alias("id"), "text"))
    units_left = F.filter("units", lambda u: likely(u["words"]))
    # the outer form, as Spark would otherwise evaluate the whole expression once more to skip empty arrays
    found = found.select("id", F.inline_outer(units_left)).where("words IS NOT NULL")
    return (
        found.select(
            F.col("id").alias("doc_id"), F.col("line").cast("long").alias("line"), F.sha2(respelled(F.col("words")), 256).alias("digest")
        )
        .join(table, "digest")
        .select("doc_id", "line", "licence", "digest")
    )
