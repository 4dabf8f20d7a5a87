"""Templates of the licence scan: whole texts of public licences, parts that stand alone, announcing sentences.

Whole texts lie in ``licences``, one file each, named by the licence. An
announcement is a licence's name in a usual wording, cut to ``SHORT`` words:
up to four shingles, of which containment 0.8 wants all, so that another
version or variant never passes for it. A name of five words or more stands by
itself; a shorter one needs the words before or after it.
"""

from __future__ import annotations

import itertools
import re
from importlib import resources

#: Words of a shingle, and of four of them.
LEAST, SHORT = 5, 8

# Words that lead to a short name, or close it.
_BEFORE = [
    *(f"{verb} under" for verb in "licensed released distributed available published provided offered shared is are".split()),
    "terms of", "conditions of", "covered by", "governed by", "subject to",
]
#: First words of names that take "an".
_AN = frozenset("apache artistic isc mit expat x11 mpl ncsa odbl lgpl agpl sil eclipse open".split())

_GNU = {
    "GPL": ("GNU General Public License", "GPL", ("1.0", "2.0", "3.0")),
    "LGPL": ("GNU Lesser General Public License", "LGPL", ("2.1", "3.0")),
    "AGPL": ("GNU Affero General Public License", "AGPL", ("3.0",)),
    "GFDL": ("GNU Free Documentation License", "GFDL", ("1.1", "1.2", "1.3")),
}
_CC = {
    "BY": ["Attribution"],
    "BY-SA": ["Attribution ShareAlike", "Attribution Share Alike"],
    "BY-ND": ["Attribution NoDerivatives", "Attribution NoDerivs", "Attribution No Derivatives"],
    "BY-NC": ["Attribution NonCommercial", "Attribution Non Commercial"],
    "BY-NC-SA": [
        "Attribution NonCommercial ShareAlike", "Attribution Non Commercial Share Alike",
        "Attribution NonCommercial Share Alike", "Attribution Non Commercial ShareAlike",
    ],
    "BY-NC-ND": [
        "Attribution NonCommercial NoDerivatives", "Attribution NonCommercial NoDerivs",
        "Attribution Non Commercial No Derivatives", "Attribution NonCommercial No Derivatives",
    ],
}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: Other licences: the names they go by.
_NAMES = {
    "Apache-2.0": ["Apache License 2.0", "Apache 2.0 License", "Apache License Version 2.0", "Apache License v2.0", "Apache License v2", "Apache License 2", "Apache 2 License", "Apache-2.0", "Apache 2.0", "Apache Software License 2.0", "Apache Software License Version 2.0"],
    "Artistic-1.0": ["Artistic License 1.0"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic License Version 2.0"],
    "BSD": ["BSD License", "BSD style license", "BSD licenses"],
    "BSD-2-Clause": ["BSD 2 Clause License", "2 Clause BSD License", "BSD 2 Clause", "Simplified BSD License", "FreeBSD License", "two clause BSD license"],
    "BSD-3-Clause": ["BSD 3 Clause License", "3 Clause BSD License", "BSD 3 Clause", "New BSD License", "Modified BSD License", "Revised BSD License", "three clause BSD license"],
    "BSL-1.0": ["Boost Software License", "Boost Software License 1.0", "Boost Software License Version 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0 license", "Creative Commons Zero", "Creative Commons CC0", "CC0 public domain dedication", "Creative Commons CC0 1.0 Universal"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License Version 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License Version 2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "European Union Public Licence v1.2", "EUPL 1.2", "EUPL Version 1.2"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License", "MIT X11 License", "MIT style license", "X11 License", "Expat License", "MIT Open Source License"],
    "MPL-1.1": ["Mozilla Public License 1.1", "Mozilla Public License Version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License v2.0", "MPL 2.0"],
    "NCSA": ["University of Illinois NCSA Open Source License", "NCSA Open Source License"],
    "ODbL-1.0": ["Open Database License", "Open Data Commons Open Database License", "ODbL 1.0"],
    "OFL-1.1": ["SIL Open Font License", "SIL Open Font License 1.1", "Open Font License Version 1.1", "SIL Open Font License Version 1.1"],
    "OGL-UK-3.0": ["Open Government Licence v3.0", "Open Government Licence 3.0", "Open Government Licence Version 3.0"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "WTFPL": ["Do What The Fuck You Want To Public License", "WTFPL"],
    "Zlib": ["zlib License", "zlib libpng License"],
}
_LINKS = {
    "Apache-2.0": ["apache.org/licenses/LICENSE-2.0", "https opensource.org/licenses/Apache-2.0"],
    "BSD-2-Clause": ["opensource.org/licenses/BSD-2-Clause"],
    "BSD-3-Clause": ["opensource.org/licenses/BSD-3-Clause"],
    "CC0-1.0": ["creativecommons.org/publicdomain/zero/1.0"],
    "ISC": ["https opensource.org/licenses/ISC", "http opensource.org/licenses/ISC"],
    "MIT": ["https opensource.org/licenses/MIT", "http opensource.org/licenses/MIT", "opensource.org/licenses/mit-license", "opensource.org/license/mit"],
    "MPL-2.0": ["mozilla.org/MPL/2.0", "opensource.org/licenses/MPL-2.0"],
    "Unlicense": ["http unlicense.org for more information", "refer to http unlicense.org", "refer to https unlicense.org"],
}

#: Passages that stand alone without the rest of their licence.
PARTS = [
    (
        "AGPL-3.0",
        "Notwithstanding any other provision of this License, if you modify the Program, your modified version must "
        "prominently offer all users interacting with it remotely through a computer network (if your version supports "
        "such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the "
        "Corresponding Source from a network server at no charge, through some standard or customary means of "
        "facilitating copying of software.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
        "removed or altered from any source distribution.",
    ),
]


#: Notices of the GNU licences; a change of name or version loses more than a fifth of their shingles.
_GNU_NOTICE = "the terms of the {} as published by the Free Software Foundation; either version {} of the License"
PARTS += [
    (f"{short}-{v}", _GNU_NOTICE.format(_GNU[short][0], n))
    for short, v, n in (("GPL", "2.0", "2"), ("GPL", "3.0", "3"), ("LGPL", "2.1", "2.1"), ("LGPL", "3.0", "3"), ("AGPL", "3.0", "3"))
]


def _words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z]+", text.lower())


def whole_texts() -> list[tuple[str, str]]:
    """Every text of ``licences``, and the conditions and disclaimers that stand alone."""
    folder = resources.files("billframe.llm").joinpath("licences")
    texts = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    bsd, mit = texts["BSD-3-Clause"], texts["MIT"]
    found = sorted(texts.items())
    found += [("BSD", x) for x in (bsd[: bsd.index("3. Neither")], bsd[bsd.index("THIS SOFTWARE IS") :])]
    return found + [("MIT", mit[mit.index("THE SOFTWARE IS PROVIDED") :])]


def _named() -> list[tuple[str, str]]:
    """(licence, name) of all wordings."""
    found = [(k, n) for k, names in _NAMES.items() for n in names]
    for short, (name, letters, versions) in _GNU.items():
        found += [(short, name), (short, letters), (short, f"{letters} license"), (short, name.removeprefix("GNU "))]
        for v, said in itertools.product(versions, ("{}", "v{}", "version {}")):
            for n in dict.fromkeys((said.format(v), said.format(v.removesuffix(".0")))):
                found += [(f"{short}-{v}", f"{x} {n}") for x in (name, f"GNU {letters}", letters)]
                found += [(f"{short}-{v}", f"{letters}{n}")] * (said == "v{}")
    for kind, spelled in _CC.items():
        for v in _CC_VERSIONS:
            key = f"CC-{kind}-{v}"
            found += [(key, f"Creative Commons {s} {v}") for s in spelled] + [(key, f"CC {kind} {v}")]
    return found


def announcements() -> list[tuple[str, str]]:
    """Every name in its usual wordings, of LEAST to SHORT words."""
    found = {}
    for key, name in _named():
        own = _words(name)
        spellings = [own, [{"license": "licence", "licence": "license"}.get(w, w) for w in own]]
        for ws in spellings:
            if len(ws) >= LEAST:
                wordings = [ws]
            else:
                before = [b.split() + a for b in _BEFORE for a in (["the"], ["an" if ws[0] in _AN else "a"], [])]
                wordings = [(b + ws)[-LEAST:] for b in before if len(b) + len(ws) >= LEAST]
                if len(ws) == LEAST - 1:
                    wordings += [[*ws, w] for w in ("license", "licence")]
                    wordings += [[*ws, w] for w in ("international", "unported") if key.startswith("CC-")]
            found |= {(key, " ".join(w[-SHORT:])): None for w in wordings}
    links = [(k, x) for k, xs in _LINKS.items() for x in xs]
    links += [(f"CC-{k}-{v}", f"creativecommons.org/licenses/{k}/{v}") for k in _CC for v in _CC_VERSIONS]
    links += [(f"{k}-{v}", f"gnu.org/licenses/{k}-{v}") for k, (_, _, vs) in _GNU.items() for v in vs]
    ids = [*_NAMES, *(f"CC-{k}-{v}" for k in _CC for v in _CC_VERSIONS), *(f"{k}-{v}" for k, (_, _, vs) in _GNU.items() for v in vs)]
    links += [(k, f"SPDX-License-Identifier: {k}") for k in ids]
    found |= {(k, " ".join(_words(x))): None for k, x in links if LEAST <= len(_words(x)) <= SHORT}
    return list(found)


#: Words of the least brief notice.
BRIEF = 3


def brief() -> list[tuple[str, str]]:
    """Notices too short for a shingle, of BRIEF to LEAST - 1 words, which are looked up whole: SPDX lines of
    one-word names, "license:" or "licensed under" before a short name, and two licences named together."""
    ids = [*_NAMES, *(f"{k}-{v}" for k, (_, _, vs) in _GNU.items() for v in vs)]
    found = [(k, f"SPDX-License-Identifier: {k}") for k in [*ids, *_GNU]]
    for key, name in [*_named(), *((k, k) for k in ids)]:
        found += [(key, f"{lead} {name}") for lead in ("license", "licence", "licensed under", "license is", "under the")]
    pairs = {"MIT": "MIT", "BSD": "BSD", "GPL": "GPL", "LGPL": "LGPL", "MPL": "MPL-2.0"}
    for a, b in itertools.permutations(pairs, 2):
        found += [(pairs[x], f"{a} {link} {b} {last}") for x in (a, b) for link in ("and", "or") for last in ("license", "licenses", "licence", "licences")]
    kept = {(k, " ".join(_words(x))): None for k, x in found if BRIEF <= len(_words(x)) < LEAST}
    return list(kept)


def templates() -> list[tuple[str, str]]:
    """(licence, text) of all of them."""
    return [*whole_texts(), *PARTS, *announcements(), *brief()]
