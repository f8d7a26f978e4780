"""License scans: Dice coefficient over word bigrams against templates.

Texts are normalised to lower-case words (letters and digits).  A passage is a
run of consecutive sentences or lines; it is compared with a template by
2 |A and B| / (|A| + |B|) over their sets of word bigrams.  Passages of at
least ``DICE`` are found, the best of those that overlap.

Pruning loses nothing: with threshold d, a passage of n bigrams can only meet
templates of n d / (2 - d) to n (2 - d) / d bigrams, and it shares at least
d / (2 - d) of a template's bigrams, so it holds one of any set of bigrams
that leaves fewer than that out.  Each template's longest bigrams are such a
set of anchors (of notices, those that the fewest templates have); a text
without an anchor is done after one look-up a word, and a template of which a
whole text shares too little is passed over.

The templates are the full texts in ``licence_texts`` and below, and notices.
A notice that gives no version (of GPL, BSD, ...) names none of them.

Defined cases: null and empty texts, and templates of fewer than two words,
match nothing; of equal passages the earlier, of equal templates the first by
name wins; repeated rows and null ids are scanned row by row; an empty table
gives an empty result; very long texts are read whole, sentence by sentence;
further columns are ignored.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table
from ranklight.llm.registry import register
from ranklight.llm.spans import sentences

DICE = 0.9
#: Bigrams of a template that is a notice rather than a text.
SHORT = 64
FOUND = "doc_id long, licence string, dice double, start long, end long"

_WORD = re.compile(r"[^\W_]+")

# The wording of public licences and of usual notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
_GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""

_UNLICENSE_REST = """In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE. For more information, please refer to <https://unlicense.org>"""
_BSD_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the organization."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
may not be removed or altered from any source distribution."""
_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE,
TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY
DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MPL_2 = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_EPL_1 = """All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse
Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"""
_EPL_2 = """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""
_CC0 = """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this
software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of
the CC0 Public Domain Dedication along with this software. If not, see <https://creativecommons.org/publicdomain/zero/1.0/>."""
_WTFPL = """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is
allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING,
DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."""

_GNU = {"AGPL-3.0": ("Affero General", "3"), "GPL-1.0": ("General", "1"), "GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"),
        "LGPL-2.0": ("Library General", "2"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3")}


def _gnu_notices(kind: str, version: str) -> list[str]:
    """The notice of a GNU licence: for programs and libraries, this version
    alone or later ones too, ending with the address, the old one or none."""
    name = f"GNU {kind} Public License"
    terms = [f"{name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) "
             "any later version.",
             f"{name} as published by the Free Software Foundation, version {version} of the License.",
             f"{name} version {version} as published by the Free Software Foundation."]
    ends = ["", f"You should have received a copy of the {name} along with this THING. If not, see <https://www.gnu.org/licenses/>.",
            f"You should have received a copy of the {name} along with this THING; if not, write to the Free Software Foundation, "
            "Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."]
    return [f"This THING is free software: you can redistribute it and/or modify it under the terms of the {t} This THING is "
            "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. {e}".replace("THING", thing)
            for t in terms for e in ends for thing in ("program", "library")]


#: Names as notices write them.
_NAMES = {
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache License v2.0", "Apache 2 License"],
    "Artistic-1.0": ["Artistic License 1.0"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal license", "CC0 1.0 Universal Public Domain Dedication"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License, version 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0"],
    "GFDL-1.2": ["GNU Free Documentation License, version 1.2"],
    "GFDL-1.3": ["GNU Free Documentation License, version 1.3"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License", "MIT Licence"],
    "MIT-0": ["MIT No Attribution License", "MIT-0 License"],
    "MPL-1.1": ["Mozilla Public License 1.1", "Mozilla Public License, version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL"],
    "Zlib": ["zlib License", "zlib/libpng License"],
} | {name: [form for v in dict.fromkeys((version, version if "." in version else version + ".0")) for form in (
        f"GNU {kind} Public License, version {v}", f"GNU {kind} Public License v{v}", f"GNU {kind} Public License {v}",
        f"GNU {short} version {v}", f"GNU {short} v{v}", f"{short} version {v}", f"{short} v{v}", f"{short} {v}", f"{short}v{v}")]
     for name, (kind, version) in _GNU.items() for short in [name.split("-")[0]]}
_CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-SA": "Attribution-ShareAlike"}
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.0": "Generic", "2.5": "Generic"}
for _k, _v in _CC.items():
    for _n, _where in _CC_VERSIONS.items():
        _NAMES[f"CC-{_k}-{_n}"] = [f"CC {_k} {_n}", f"CC {_k} {_n} license", f"Creative Commons {_v} {_n} {_where} License",
                                   f"Creative Commons {_v} {_n} License"]
#: Ways to name a licence in one sentence.
_FORMS = ["Licensed under {}.", "Released under {}.", "Distributed under {}.", "Published under {}.", "Available under {}.",
          "Licensed under the terms of {}."]
_FORMS += [f"{thing} is {how}" for thing in ("This work", "This project", "This software", "This program", "This library", "This code",
                                             "The code", "The source code", "This package", "This file", "This repository")
           for how in ("licensed under {}.", "released under {}.", "distributed under {}.", "available under {}.",
                       "licensed under the terms of {}.", "distributed under the terms of {}.")]
_FORMS += [f"This {thing} is licensed under {{}} - see the LICENSE file for details." for thing in ("project", "software", "work")]


def _notices(name: str) -> list[str]:
    article = [""] if name.startswith("CC ") else ["the "]
    article = ["a "] if name.startswith("Creative Commons A") else article
    return [form.format(a + name) for form in _FORMS for a in article]


def _full(name: str) -> str:
    return pkgutil.get_data("ranklight.llm", f"licence_texts/{name}.txt").decode("utf-8")


def _templates() -> dict[str, list[str]]:
    out = {name: [n for written in names for n in _notices(written)] for name, names in _NAMES.items()}
    for name, (kind, version) in _GNU.items():
        out[name] += [*_gnu_notices(kind, version), _full(name)]
    for name in ("Apache-2.0", "Artistic-1.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "MPL-1.1", "MPL-2.0"):
        out[name].append(_full(name))
    grant = _MIT[:_MIT.index(", subject to")] + ". "
    disclaimer = _MIT[_MIT.index("THE SOFTWARE IS PROVIDED"):]
    for name, texts in {
            "0BSD": [_ISC[:_ISC.index(", provided")] + ". " + _ISC[_ISC.index("THE SOFTWARE"):]],
            "Apache-2.0": [_APACHE_NOTICE],
            "BSD-2-Clause": [f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"],
            "BSD-3-Clause": [f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"],
            "BSD-4-Clause": [f"{_BSD_CONDITIONS} {_BSD_ADVERTISING} {_BSD_NAMES.replace('3.', '4.')} {_BSD_DISCLAIMER}"],
            "BSL-1.0": [_BSL, "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or "
                              "copy at https://www.boost.org/LICENSE_1_0.txt)"],
            "CC0-1.0": [_CC0], "EPL-1.0": [_EPL_1, _EPL_1.removeprefix("All rights reserved. ")], "EPL-2.0": [_EPL_2],
            "GPL-3.0": [_GPL_NOTICE], "ISC": [_ISC], "MIT": [_MIT], "MIT-0": [grant + disclaimer], "MPL-2.0": [_MPL_2],
            "Unlicense": [_UNLICENSE, f"{_UNLICENSE} {_UNLICENSE_REST}"], "WTFPL": [_WTFPL], "Zlib": [_ZLIB]}.items():
        out.setdefault(name, []).extend(texts)
    return {name: list(dict.fromkeys(texts)) for name, texts in sorted(out.items())}


TEMPLATES: dict[str, list[str]] = _templates()


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Templates:
    """Templates as bigram sets over their own vocabulary."""

    def __init__(self, templates: dict[str, list[str]] | None = None, threshold: float = DICE):
        self.threshold, self.vocabulary = threshold, {}
        self.templates: list[tuple[str, frozenset, float, float]] = []
        self.anchors: dict[tuple, list[int]] = defaultdict(list)
        share = threshold / (2 - threshold)
        templates = templates or TEMPLATES
        split = [_WORD.findall(text.lower()) for texts in templates.values() for text in texts]
        usual = Counter(g for words in split for g in set(zip(words, words[1:])))
        for name, texts in sorted(templates.items()):
            for text in texts:
                words = _WORD.findall(text.lower())
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                grams = frozenset(zip(ids, ids[1:]))
                if not grams:
                    continue
                n = len(grams)
                # Of short templates first the bigrams that few others have.
                longest = sorted(zip(words, words[1:]), key=lambda g: (usual[g] if n < SHORT else 0, -len(g[0]) - len(g[1]), g))
                longest = list(dict.fromkeys((self.vocabulary[a], self.vocabulary[b]) for a, b in longest))
                for g in longest[:n - math.ceil(share * n - 1e-9) + 1]:
                    self.anchors[g].append(len(self.templates))
                self.templates.append((name, grams, n * share - 1e-9, n / share + 1e-9))

    def _hit(self, text: str) -> bool:
        get = self.vocabulary.get
        ids = [get(w, 0) for w in _WORD.findall(text.lower())]
        return not self.anchors.keys().isdisjoint(zip(ids, ids[1:]))

    def find(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(licence, dice, start, end) of the best passages, by place."""
        if not text or not self._hit(text):
            return []
        get = self.vocabulary.get
        bounds = sentences(text)
        words = [[get(w, 0) or -1 for w in _WORD.findall(text[s:e].lower())] for s, e in bounds]
        # Words that no template has differ from each other: they only add bigrams.
        unknown, rows = 0, []
        for row in words:
            out = []
            for w in row:
                unknown -= w < 0
                out.append(w if w > 0 else unknown)
            rows.append(out)
        near: dict[int, set] = defaultdict(set)  # template: sentences where an anchor begins or goes on
        last = (None, 0)
        for k, row in enumerate(rows):
            for i, w in enumerate(row):
                for t in self.anchors.get((last[0], w), ()):
                    near[t] |= {last[1], k}
                last = (w, k)
        found = []
        words = [w for r in rows for w in r]
        own = set(zip(words, words[1:]))
        for t, at in near.items():
            name, grams, low, high = self.templates[t]
            if len(grams & own) < low:  # no passage can share enough
                continue
            known = {x for g in grams for x in g}
            # Sentences without a word of the template only take away.
            useful = [bool(known.intersection(r)) for r in rows[:max(at) + 1]]
            done = set()
            for k in sorted(at):
                i = k
                while i >= 0 and sum(map(len, rows[i:k])) <= high + 1:
                    if useful[i] and i not in done:
                        done.add(i)
                        found += self._runs(t, i, rows, bounds, grams, low, high, name)
                    i -= 1
        found.sort(key=lambda f: (-f[1], f[2] - f[3], f[2], f[0]))
        out: list[tuple] = []
        for f in found:
            if all(f[3] <= g[2] or f[2] >= g[3] for g in out):
                out.append(f)
        return sorted(out, key=lambda f: f[2])

    def _runs(self, t, i, rows, bounds, grams, low, high, name):
        """Passages that begin with sentence i and reach the threshold."""
        own: set = set()
        before, shared, n = None, 0, len(grams)
        for j in range(i, len(rows)):
            for w in rows[j]:
                g = (before, w)
                if before is not None and g not in own:
                    own.add(g)
                    shared += g in grams
                before = w
            if len(own) > high:
                return
            if len(own) >= low and (d := 2 * shared / (len(own) + n)) >= self.threshold:
                yield name, d, bounds[i][0], bounds[j][1]


def _finder(templates, threshold: float):
    def run(batches):
        ready = Templates(templates, threshold)
        for batch in batches:
            out = [(doc.as_py(), *f) for doc, text in zip(batch.column(0), batch.column(1), strict=True) for f in ready.find(text.as_py())]
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "licence", "dice", "start", "end"])
    return run


def licences(documents: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = DICE) -> DataFrame:
    """One row per licence passage: doc_id, licence, dice, start, end (code points)."""
    prepare(documents, "doc_id", "text")
    d = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.mapInArrow(_finder(templates, threshold), FOUND)


@register("op10_licence_dice")
def op10_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in every document."""
    return licences(table(spark, sf_dir, "documents"))
