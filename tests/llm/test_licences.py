"""License scans against a version that tries every passage."""

import random

import pytest

from ranklight.llm import licences as lc
from ranklight.llm.spans import sentences


def _grams(text):
    w = lc._WORD.findall(text.lower())
    return set(zip(w, w[1:]))


def _brute(text, templates, threshold):
    bounds, found = sentences(text), []
    for name, texts in templates.items():
        for t in texts:
            g = _grams(t)
            for i in range(len(bounds)):
                for j in range(i, len(bounds)):
                    d = lc.dice(_grams(text[bounds[i][0]:bounds[j][1]]), g)
                    if g and d >= threshold:
                        found.append((name, d, bounds[i][0], bounds[j][1]))
    found.sort(key=lambda f: (-f[1], f[2] - f[3], f[2], f[0]))
    out = []
    for f in found:
        if all(f[3] <= g[2] or f[2] >= g[3] for g in out):
            out.append(f)
    return [(n, round(d, 9)) for n, d, _, _ in sorted(out, key=lambda f: f[2])]


@pytest.mark.parametrize("seed", range(25))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    templates = {"T1": ["a b c d e f. g h i j k l m n o p"], "T2": ["a b c d"], "T3": ["x"]}
    words = "a b c d e f g h i j k l m n o p".split()
    text = ""
    for _ in range(6):
        part = list(words) if rng.random() < .5 else words[:4]
        for _ in range(rng.randint(0, 3)):
            part[rng.randrange(len(part))] = rng.choice(["zz", "a", "c", "qq"])
        text += " ".join(w + rng.choice(["", "", "", ".", "\n"]) for w in part) + ". "
    for threshold in (0.6, 0.8, 0.9):
        got = lc.Templates(templates, threshold).find(text)
        assert [(n, round(d, 9)) for n, d, _, _ in got] == _brute(text, templates, threshold)


def test_texts_and_notices(spark, docs):
    rows = [(1, "Some prose. Released under the MIT License. More prose."), (2, "x y z\n\nCopyright (c) 2020 A Name\n\n" + lc._MIT),
            (3, lc._BSD_CONDITIONS + "\n" + lc._BSD_NAMES + "\n" + lc._BSD_DISCLAIMER), (4, "Licensed under CC BY-NC 4.0. Rest of the line"),
            (5, "licensed under the  APACHE license version 2.0"), (6, "The license of the of the software is provided."), (7, None),
            (8, ""), (9, "of the " * 50000), (None, "This work is licensed under the GNU General Public License, version 3."),
            (1, "Some prose. Released under the MIT License. More prose."), (10, lc._MIT[:len(lc._MIT) // 2])]
    got = {}
    for r in lc.licences(docs(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {k: [r.licence for r in v] for k, v in got.items()} == {
        1: ["MIT", "MIT"], 2: ["MIT"], 3: ["BSD-3-Clause"], 4: ["CC-BY-NC-4.0"], 5: ["Apache-2.0"], None: ["GPL-3.0"]}
    assert rows[0][1][got[1][0].start:got[1][0].end] == "Released under the MIT License."
    assert lc.licences(docs([])).count() == 0


def test_near_neighbours_get_their_own_name():
    ready = lc.Templates()

    def names(text):
        return [f[0] for f in ready.find(text)]
    gpl = lc._GPL_NOTICE
    assert names(gpl) == ["GPL-3.0"]
    assert names(gpl.replace("General Public", "Affero General Public")) == ["AGPL-3.0"]
    assert names(gpl.replace("General Public", "Lesser General Public")) == ["LGPL-3.0"]
    assert names(gpl.replace("version 3", "version 2")) == ["GPL-2.0"]
    assert names(gpl.replace("General Public", "Lesser General Public").replace("version 3", "version 2.1")) == ["LGPL-2.1"]
    assert names("A tool.\nThis project is licensed under the MIT License.\nMore.") == ["MIT"]
    assert names("Released under the GPLv2.") == ["GPL-2.0"] and names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0"]
    assert names(lc._ZLIB) == ["Zlib"] and names(lc._BSL) == ["BSL-1.0"] and names(lc._MPL_2) == ["MPL-2.0"]
    assert names(lc.TEMPLATES["0BSD"][-1]) == ["0BSD"] and names(lc._EPL_2) == ["EPL-2.0"]


@pytest.mark.parametrize("name", ["AGPL-3.0", "Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"])
def test_full_texts(name):
    text = lc._full(name)
    found = lc.Templates().find(f"Some prose before.\n{text}\nSome prose after.")
    assert {f[0] for f in found} == {name} and max(e - s for _, _, s, e in found) > 0.8 * len(text)


def test_every_template_is_found_as_its_licence():
    ready = lc.Templates()
    for name, texts in lc.TEMPLATES.items():
        for t in texts[::9]:
            if len(t) < 4000:
                assert {f[0] for f in ready.find(t)} == {name}, t
