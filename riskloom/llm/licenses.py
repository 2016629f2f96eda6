"""License scans by canonical digests of entire texts.

A text, each of its blank-line separated paragraphs and each of its lines is normalised (case,
punctuation, copyright lines, equivalent spellings) and its digest joined with the digests of
known licence texts. Known texts are also sequences of blocks, cut at lines without words and at
copyright lines with or without a year; a sequence whose digests a document holds in a row is a
passage. Nothing but a whole unit or a whole sequence can match.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.llm.common import pieces, some_texts, stored
from riskloom.operators.ordered import sized

#: Public licence texts and notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = _BSD_2 + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This {0} is free software{1} you can redistribute it and/or modify it under the terms of the {2} as published by the Free Software Foundation{3} version {4} of the License{5}

This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {2} for more details."""
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
#: Short and long names of a licence as notices write them.
NAMES: dict[str, Sequence[str]] = {
    "MIT": ("MIT", "MIT License", "MIT/X11 License", "Expat License"),
    "ISC": ("ISC", "ISC License"),
    "Apache-2.0": ("Apache 2.0", "Apache-2.0", "Apache License 2.0", "Apache License Version 2.0", "Apache 2.0 License", "Apache Software License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause", "BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause", "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "GPL-2.0": ("GPL-2.0", "GPLv2", "GNU GPL Version 2", "GNU General Public License Version 2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GPL-3.0", "GPLv3", "GNU GPL Version 3", "GNU General Public License Version 3", "GNU General Public License v3.0"),
    "LGPL-2.1": ("LGPL-2.1", "LGPLv2.1", "GNU LGPL Version 2.1", "GNU Lesser General Public License Version 2.1"),
    "LGPL-3.0": ("LGPL-3.0", "LGPLv3", "GNU LGPL Version 3", "GNU Lesser General Public License Version 3", "GNU Lesser General Public License v3.0"),
    "AGPL-3.0": ("AGPL-3.0", "AGPLv3", "GNU AGPL Version 3", "GNU Affero General Public License Version 3", "GNU Affero General Public License v3.0"),
    "MPL-2.0": ("MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0"),
    "Unlicense": ("Unlicense",),
    "0BSD": ("0BSD", "Zero-Clause BSD License", "BSD Zero Clause License"),
    "Zlib": ("zlib", "zlib License"),
    "BSL-1.0": ("BSL-1.0", "Boost Software License 1.0", "Boost Software License Version 1.0"),
    "EPL-2.0": ("EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License Version 2.0", "Eclipse Public License v2.0"),
    "CC0-1.0": ("CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    **{
        f"CC-{code}-{number}": (
            f"CC {code} {number}", f"Creative Commons {name} {number}", f"Creative Commons {name} {number} {area}",
            f"Creative Commons {name} {number} {area} License", f"Creative Commons {name} {number} License",
        )
        for code, name in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for number, area in (("4.0", "International"), ("3.0", "Unported"))
    },
}
_SUBJECTS = ("", *(f"This {x} is " for x in ("work", "file", "program", "software", "project", "code")))
_VERBS, _ARTICLES = ("Licensed under ", "Released under ", "Distributed under "), ("", "the ", "the terms of the ")


def notices(license: str, names: Sequence[str]) -> list[str]:
    """The one-line notices of a licence: subject, verb, article and name, and SPDX lines."""
    later = [f"SPDX-License-Identifier: {license}-{x}" for x in ("only", "or-later")] if "GPL" in license else []
    articles = (*_ARTICLES, "a ") if license.startswith("CC-") else _ARTICLES
    lines = [s + v + a + n + "." for s in _SUBJECTS for v in _VERBS for a in articles for n in names]
    return [*lines, f"SPDX-License-Identifier: {license}", *later]


def _gnu_notices(name: str, number: str) -> list[str]:
    """The notices that the GNU licences ask for, for one version and for later ones too."""
    out = []
    for what in ("program", "library", "software", "file"):
        for colon, either, later in ((":", ", either", ", or (at your option) any later version."), (":", ",", "."), (";", "; either", ", or (at your option) any later version."), (";", "; only", ".")):
            body = _GNU.format(what, colon, name, either, number, later)
            out += [body, f"{body}\n\nYou should have received a copy of the {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."]
    return out


def _published() -> dict[str, list[str]]:
    """Full texts as published (files of this folder), also without the appendix behind the terms."""
    out, end = {}, "END OF TERMS AND CONDITIONS"
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        body = path.read_text("utf-8")
        out[path.stem] = [body, *([body[: body.index(end)], body[: body.index(end) + len(end)]] if end in body else [])]
    return out


_TEXTS: dict[str, Sequence[str]] = {
    "MIT": (_MIT, "MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT, "The MIT License\n\n" + _MIT),
    "ISC": (_ISC, "ISC License\n\n" + _ISC, "The ISC License\n\n" + _ISC),
    "Apache-2.0": (_APACHE,),
    "BSD-2-Clause": (_BSD_2 + _BSD_END, "BSD 2-Clause License\n\n" + _BSD_2 + _BSD_END),
    "BSD-3-Clause": (_BSD_3 + _BSD_END, "BSD 3-Clause License\n\n" + _BSD_3 + _BSD_END),
    "GPL-2.0": _gnu_notices("GNU General Public License", "2"), "GPL-3.0": _gnu_notices("GNU General Public License", "3"),
    "LGPL-2.1": _gnu_notices("GNU Lesser General Public License", "2.1"), "LGPL-3.0": _gnu_notices("GNU Lesser General Public License", "3"),
    "AGPL-3.0": _gnu_notices("GNU Affero General Public License", "3"),
    "MPL-2.0": (_MPL, _MPL + " If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Proprietary": ("All rights reserved.",),
}
_FILES = _published()
#: Full texts first, then notices; every licence that any of the tables names.
KNOWN: dict[str, Sequence[str]] = {
    name: list(dict.fromkeys([*_TEXTS.get(name, ()), *_FILES.get(name, ()), *(notices(name, NAMES[name]) if name in NAMES else ())]))
    for name in dict.fromkeys([*NAMES, *_TEXTS, *_FILES])
}
#: Spellings that count as equal, by word (the published matching guidelines).
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "acknowledgement": "acknowledgment",
    "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog",
    "centre": "center", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "labour": "labor",
    "organisation": "organization", "recognise": "recognize", "sublicence": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful", "ver": "version", "v": "version", "https": "http", "noncommercial": "non commercial",
}
#: A line that is only a copyright statement (holder and years differ from copy to copy).
COPYRIGHT_LINE = regex.compile(r"(?i)^[^\p{L}\n]*(?:copyright|\(c\)|©)[^\n]*\d{4}[^\n]*$")
#: Also holders without a year: after the word and sign, or behind a bare (c) if only names follow.
_HOLDER = regex.compile(
    r"(?i)^[^\p{L}\n]*(?:(?:copyright|\(c\)|©)[^\n]*\d{4}[^\n]*|copyright[ \t]*(?:\(c\)|©)[^\n]*|©[^\n]*"
    r"|copyright[ \t]+(?!(?:and|holders?|notices?|owners?|law|laws|act|licen[sc]es?)\b)(?-i:\p{Lu}|[Tt]he[ \t]+\p{Lu}|by[ \t])[^\n]*"
    r"|\(c\)(?-i:(?:[ \t]+\p{Lu}[\p{L}.'’-]*,?){1,6})[^\p{L}\n]*)$"
)
_RESERVED = regex.compile(r"(?i)^[^\p{L}\n]*all rights reserved[^\p{L}\n]*$")
_PARAGRAPHS = re.compile(r"\n[ \t\r]*\n")
#: Characters beyond ASCII that are neither letters nor digits.
_ODD = re.compile(r"[^\x00-\x7f\w]")
_WORDS = bytes.maketrans(
    bytes(c for c in range(128) if c != 10 and not chr(c).isalnum()), b" " * sum(c != 10 and not chr(c).isalnum() for c in range(128))
)
#: Places of the filter for shapes (number of words and first word) that known units have.
SHAPES = 1 << 20
_UNIT = "unit string, place int, n int, shape int, digest string"


def _spelled(norm: bytes) -> bytes:
    """Words of a unit with one spelling each; the table is applied in its order."""
    out = b" %s " % norm
    for old, new in _SPELLINGS:
        out = out.replace(old, new)
    return out.strip(b" ")


_SPELLINGS = [(f" {old} ".encode(), f" {new} ".encode()) for old, new in SPELLINGS.items()]
_VARIANTS = frozenset(old.encode() for old in SPELLINGS)


def shape(words: int, first: bytes) -> int:
    return zlib.crc32(b"%d %s" % (words, first)) % SHAPES


class Cut:
    """A text normalised once, line by line, and its units."""

    def __init__(self, text: str):
        self.lower = low = text.lower()
        # Not by ``splitlines``: only a line feed ends a line.
        clean = low if low.isascii() else _ODD.sub(" ", low)
        self.words = [line.split() for line in clean.encode("utf-8", "replace").translate(_WORDS).split(b"\n")]
        self.worded = [bool(w) for w in self.words]
        self.holder: set[int] = set()
        if "copyright" in low or "(c)" in low or "©" in low:
            lines = text.split("\n")
            if len(lines) == len(self.words):
                self._drop_holders(lines)

    def _drop_holders(self, lines: list[str]) -> None:
        for i, line in enumerate(lines):
            low = line.lower()
            if "copyright" not in low and "(c)" not in low and "©" not in low:
                continue
            if _HOLDER.match(line):
                self.holder.add(i)
                if i + 1 < len(lines) and _RESERVED.match(lines[i + 1]):
                    self.holder.add(i + 1)
            if COPYRIGHT_LINE.match(line):
                self.words[i] = []

    def units(self, wanted: np.ndarray | None) -> Iterator[tuple[str, int, int, int, str]]:
        """``unit, place, n, shape, digest`` of the units whose shape is ``wanted`` (all, if None)."""
        words = self.words
        varied = [not _VARIANTS.isdisjoint(w) for w in words]
        sizes = [len(w) for w in words]

        def one(unit: str, place: int, n: int, lo: int, hi: int) -> Iterator[tuple[str, int, int, int, str]]:
            count, i = sum(sizes[lo:hi]), lo
            if not count:
                return
            while not sizes[i]:
                i += 1
            if any(varied[lo:hi]):
                found = _spelled(b" ".join(x for w in words[lo:hi] for x in w)).split(b" ")
                key = shape(len(found), found[0])
            else:
                found, key = None, shape(count, words[i][0])
            if wanted is None or wanted[key]:
                found = found or [x for w in words[lo:hi] for x in w]
                yield unit, place, n, key, hashlib.sha256(b" ".join(found)).hexdigest()

        yield from one("text", 0, 0, 0, len(words))
        line, start, place = 0, 0, 0
        low = self.lower
        for m in chain(_PARAGRAPHS.finditer(low), [None]):
            inner = low.count("\n", start, m.start() if m else len(low))
            if inner:
                yield from one("paragraph", place, 0, line, line + inner + 1)
                place += 1
            if m:
                line, start = line + inner + 2, m.end()
        if wanted is None:
            for i in range(len(words)):
                yield from one("line", i, 0, i, i + 1)
        else:
            for i, w in enumerate(words):
                if w and (varied[i] or wanted[shape(len(w), w[0])]):
                    yield from one("line", i, 0, i, i + 1)
        spans, begin = [], None
        for i, some in enumerate(self.worded):
            if some and i not in self.holder:
                begin = i if begin is None else begin
            elif begin is not None:
                spans.append((begin, i))
                begin = None
        if begin is not None:
            spans.append((begin, len(words)))
        for k, (lo, hi) in enumerate(spans):
            yield from one("block", k, len(spans), lo, hi)


def _cut(rows: DataFrame, text: str, wanted: bytes | None) -> DataFrame:
    """All columns but the text, with one row per unit (columns ``_UNIT``) whose shape is wanted."""
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*kept, *T._parse_datatype_string(_UNIT).fields])
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else np.unpackbits(np.frombuffer(wanted, np.uint8)).astype(bool)
        for batch in pieces(batches, text):
            at, found, k = [], [], 0
            for texts in some_texts(batch.column(batch.schema.get_field_index(text))):
                for t in texts:
                    units = list(Cut(t or "").units(known))
                    at += [k] * len(units)
                    found += units
                    k += 1
            if found:
                place = pa.array(at, pa.int64())
                columns = [batch.column(f.name).take(place) for f in kept]
                columns += [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def registry(spark: SparkSession, known: Mapping[str, Sequence[str]] = KNOWN) -> DataFrame:
    """``digest, license, sequences, shapes`` of known texts; the smallest name where two share a digest.

    ``sequences``: the block digests of each such text in order; ``shapes``: those of the text and its blocks.
    """
    rows = [(i, name, text) for i, (name, text) in enumerate((n, t) for n, texts in known.items() for t in texts)]
    units = _cut(spark.createDataFrame(rows, "id long, license string, text string"), "text", None)
    block = F.col("unit") == "block"
    texts = units.where(block | (F.col("unit") == "text")).groupBy("id", "license").agg(
        F.max(F.when(F.col("unit") == "text", F.col("digest"))).alias("digest"),
        F.array_sort(F.collect_list(F.when(block, F.struct("place", "digest")))).alias("blocks"), F.collect_set("shape").alias("shapes"),
    )
    return texts.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("license").alias("license"), F.collect_set(F.transform("blocks", lambda b: b["digest"])).alias("sequences"),
        F.array_distinct(F.flatten(F.collect_list("shapes"))).alias("shapes"),
    )


def _wanted(known: DataFrame) -> bytes:
    """One bit per shape: a bound that doesn't grow with the registry."""
    bits = np.zeros(SHAPES, bool)
    bits[[r[0] for r in known.select(F.explode("shapes")).distinct().collect()]] = True
    return np.packbits(bits).tobytes()


def _keys(known: DataFrame) -> DataFrame:
    """``key, license, sequence, size, at``: digests of whole texts (size 0) and of blocks at their place in a sequence."""
    whole = known.select(F.col("digest").alias("key"), "license", F.lit(0).alias("sequence"), F.lit(0).alias("size"), F.lit(0).alias("at"))
    whole = whole.withColumn("sequence", F.xxhash64("key"))
    parts = known.select("license", F.explode("sequences").alias("s")).where(F.size("s") > 0).groupBy("s").agg(F.min("license").alias("license"))
    parts = parts.select("license", F.xxhash64("s").alias("sequence"), F.size("s").alias("size"), F.posexplode("s").alias("at", "key"))
    return whole.unionByName(parts.select(*whole.columns))


def _passages(hits: DataFrame) -> DataFrame:
    """Whole sequences in a row of blocks that no unit of the same text reports already.

    A text that matches as a whole has no passages. A sequence of one block counts only where no
    unit of the text has its licence; a sequence inside a longer one doesn't count.
    """
    by_block = hits.where("unit = 'block'").groupBy("row", "doc_id", "n", "license", "sequence", "size", (F.col("place") - F.col("at")).alias("first"))
    whole = by_block.agg(F.countDistinct("at").alias("found")).where("found = size")
    units = hits.where("unit <> 'block'").groupBy(F.col("row").alias("_row")).agg(
        F.max(F.col("unit") == "text").alias("_text"), F.collect_set("license").alias("_had")
    )
    open_ = whole.join(units, F.col("row") == F.col("_row"), "left").where(
        "NOT coalesce(_text, false) AND (size > 1 OR NOT coalesce(array_contains(_had, license), false))"
    )
    one = F.struct("first", (F.col("first") + F.col("size")).alias("stop"), "license")
    rows = open_.groupBy("row", "doc_id", "n").agg(F.collect_set(one).alias("all"))
    inside = lambda v, w: (w["first"] <= v["first"]) & (w["stop"] >= v["stop"]) & (
        (w["first"] < v["first"]) | (w["stop"] > v["stop"]) | (w["license"] < v["license"])
    )
    kept = F.filter("all", lambda v: ~F.exists("all", lambda w: inside(v, w)))
    rows = rows.select("doc_id", "n", F.explode(kept).alias("p")).select("doc_id", "n", "p.*")
    entire = (F.col("first") == 0) & (F.col("stop") == F.col("n"))
    return rows.select("doc_id", F.when(entire, "text").otherwise("passage").alias("unit"), F.col("first").alias("place"), "license")


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Matches ``doc_id, unit, place, license``; unit is text, paragraph, line or passage.

    Places count from 0: paragraphs, lines, or the blocks of a passage. A text is normalised once, line
    by line; its units are put together from lines and get a digest if a known unit has as many
    words and the same first one. Digests are joined with keys that are sent to the executors if
    their measured size allows; texts don't move, matches are stored. A unit without words matches nothing; null and empty texts
    have no units; repeated documents give repeated matches.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = _cut(rows.withColumn("row", F.monotonically_increasing_id()), "text", _wanted(known)).withColumnRenamed("digest", "key").drop("shape")
    keys = sized(_keys(known))
    hits = stored(rows.join(keys, "key").where((F.col("unit") == "block") == (F.col("size") > 0)).drop("key"), "licenses")
    found = hits.where("unit <> 'block'").select("doc_id", "unit", "place", "license")
    return found.unionByName(_passages(hits))


def summary(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per id: ``doc_id, text_license`` (the whole text's, or null), ``n_matches, licenses``."""
    found = scan(docs, known, doc_id, text).groupBy("doc_id").agg(
        F.min(F.when(F.col("unit") == "text", F.col("license"))).alias("text_license"), F.count(F.lit(1)).alias("n_matches"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
    ).withColumnRenamed("doc_id", "_id")
    ids = docs.select(F.col(doc_id).alias("doc_id"))
    return ids.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "text_license", F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches"), F.coalesce("licenses", F.lit("")).alias("licenses")
    )
