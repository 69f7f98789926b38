"""Licence scans by a trained paragraph classifier.

A softmax regression over sparse word n-grams names the licence family of a paragraph, or "unknown". Its logits are calibrated
by a temperature fitted on held-out examples, and unknown is a class of its own: prose that looks like licences, licences
that aren't among the families, and notices that deny one. A prediction counts if its probability reaches SURE and a
template confirms it: either the words that distinguish one of the family's names stand in the paragraph, in order and close
together, without a word that would make it another family's name, or the paragraph holds MATCH of the words of a sentence of
the licence's text, in order, all its numbers among them. A paragraph may name several licences: its parts between "and", "or", commas and brackets are
predicted as well, unless the whole is surely none; beside a licence, a part that is nothing but a name is another one.

A line is a paragraph. Lines that name none, or a family without its version, are joined with their neighbours up to a blank one, without comment marks, and the
shortest stretch of lines that names a further family counts as one paragraph: licences are wrapped in files.

The training examples are made from a seed: names in many forms within many kinds of notices, and sentences of the texts, so
the weights are the same everywhere. N-grams count near a word of STRONG only; a paragraph without such a word has no features
and is unknown, so it isn't scored.

Defined cases: a null or empty text has no licences; whole texts are read; a family found several times is listed once,
with the number of its paragraphs; a version that isn't stated gives the family without a version; of two families equally
likely the first by name is taken; rows with equal ids or texts are scanned each; an empty table gives an empty result;
other columns have no part in it.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches

SURE, MATCH, SURELY_NONE = 0.5, 0.7, 0.7
UNKNOWN = "unknown"

# Licence families by SPDX name, each with the forms in which notices name it.
NAMES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache License v2", "Apache Software License 2.0", "Apache2", "ASL 2.0", "APL 2.0", "Apache 2"),
    "MIT": ("MIT", "MIT License", "The MIT License (MIT)", "MIT licence", "Expat License", "MIT/X11 License"),
    "ISC": ("ISC", "ISC License", "ISC licence"),
    "BSD-2-Clause": ("BSD-2-Clause", "BSD 2-Clause License", "2-clause BSD license", "Simplified BSD License", "FreeBSD License", "two-clause BSD"),
    "BSD-3-Clause": ("BSD-3-Clause", "BSD 3-Clause License", "3-clause BSD license", "New BSD License", "Modified BSD License", "Revised BSD license", "BSD 3", "three-clause BSD"),
    "BSD-4-Clause": ("BSD-4-Clause", "BSD 4-Clause License", "4-clause BSD license", "Original BSD License"),
    "BSD": ("BSD", "BSD License", "BSD-style license", "Berkeley Software Distribution license"),
    "GPL-2.0": ("GPL-2.0-only", "GPL-2.0-or-later", "GPLv2", "GPL v2", "GPL 2", "GPL-2.0", "GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GNU GPLv2", "GPL2"),
    "GPL-3.0": ("GPL-3.0-only", "GPL-3.0-or-later", "GPLv3", "GPL v3", "GPL 3", "GPL-3.0", "GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GNU GPLv3", "GPL3"),
    "GPL": ("GPL", "GNU GPL", "GNU General Public License", "GNU Public License"),
    "LGPL-2.1": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPLv2.1", "LGPL 2.1", "GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3", "LGPL 3", "GNU Lesser General Public License, version 3", "GNU LGPL v3", "GNU Lesser General Public License v3.0"),
    "LGPL": ("LGPL", "GNU LGPL", "GNU Lesser General Public License", "GNU Library General Public License"),
    "AGPL-3.0": ("AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3", "AGPL 3", "GNU Affero General Public License, version 3", "GNU AGPL v3", "GNU Affero General Public License v3.0"),
    "AGPL": ("AGPL", "GNU AGPL", "GNU Affero General Public License"),
    "MPL-2.0": ("MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0"),
    "MPL-1.1": ("MPL-1.1", "MPL 1.1", "Mozilla Public License 1.1", "Mozilla Public License, version 1.1"),
    "EPL-2.0": ("EPL-2.0", "EPL 2.0", "Eclipse Public License 2.0", "Eclipse Public License v 2.0"),
    "EPL-1.0": ("EPL-1.0", "EPL 1.0", "Eclipse Public License 1.0", "Eclipse Public License - v 1.0"),
    "EUPL-1.2": ("EUPL-1.2", "EUPL v1.2", "European Union Public Licence 1.2", "European Union Public License, version 1.2"),
    "Artistic-2.0": ("Artistic-2.0", "Artistic License 2.0", "The Artistic License 2.0"),
    "BSL-1.0": ("BSL-1.0", "Boost Software License 1.0", "Boost Software License, Version 1.0", "Boost Software License"),
    "Zlib": ("Zlib", "zlib License", "zlib/libpng license"),
    "CDDL-1.0": ("CDDL-1.0", "CDDL 1.0", "Common Development and Distribution License 1.0", "CDDL"),
    "OFL-1.1": ("OFL-1.1", "SIL Open Font License 1.1", "SIL Open Font License, Version 1.1", "SIL OFL 1.1"),
    "WTFPL": ("WTFPL", "WTFPL license"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "CC0-1.0": ("CC0-1.0", "CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
}
# The terms of Creative Commons licences, short and long, and the versions that are told apart.
TERMS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
for _terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    _long = "-".join(TERMS[t] for t in _terms.split("-"))
    for _v in ("4.0", "3.0"):
        NAMES[f"CC-{_terms}-{_v}"] = (f"CC-{_terms}-{_v}", f"CC {_terms} {_v}", f"Creative Commons {_long} {_v}", f"Creative Commons {_long.replace('-', ' ')} {_v} International", f"Creative Commons {_terms} {_v}", f"Creative Commons {_long.replace('NonCommercial', 'Non-Commercial').replace('NoDerivatives', 'No Derivatives').replace('ShareAlike', 'Share Alike')} {_v}")
# Sentences of licences and of their notices.
TEXTS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS", "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive"),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    "BSD-3-Clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",),
    "BSD-4-Clause": ("All advertising materials mentioning features or use of this software must display the following acknowledgement",),
    "GPL-3.0": ("it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "GPL-2.0": ("it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "LGPL-3.0": ("it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",),
    "LGPL-2.1": ("modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",),
    "AGPL-3.0": ("it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",),
    "EUPL-1.2": ("Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission subsequent versions of the EUPL",),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",),
    "Zlib": ("This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1",),
    "WTFPL": ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",),
    "Proprietary": ("All rights reserved. Unauthorized copying of this file is strictly prohibited.", "Copyright. All rights reserved.", "This software is proprietary and confidential. Unauthorized copying, via any medium, is strictly prohibited"),
}
# Kinds of notices; {} is where the name stands.
NOTICES = (
    "{}", "Licensed under the {}.", "Licensed under {}", "Released under the {}.", "Released under {}", "License: {}", "Licence: {}", "This project is {} licensed.", "This project is licensed under the {} - see the LICENSE file for details", "SPDX-License-Identifier: {}", "Distributed under the terms of the {}.", "This work is licensed under the {}.",
    "This work is licensed under a {} license.", "available under the {}", "covered by the {}", "{} license", "## License {}", "All code is {}", "The source code is made available under {}", "under the terms of the {}, see COPYING", "Content is available under {} unless otherwise noted", "license = {}", "'license' => '{}'", "Use of this source code is governed by the {} that can be found in the LICENSE file", "published under {}", "is free software under the {}", "You can use it under {}", "Code under {}.", "(c) 2020 Someone, {}",
)
# Ways to name a licence without giving it.
DENIALS = (
    "not licensed under the {}", "this is not {} licensed", "is no longer licensed under the {}", "this code is not released under {}", "it is not available under the {}", "unlike the {} it has no such clause", "incompatible with the {}", "we never released it under {}", "cannot be relicensed under the {}", "is neither {} nor anything like it", "the {} was rejected by the board", "they moved away from {} last year", "not covered by the {}", "not under {}",
)
# Licences that are no families here, and sentences that look like licences and are none.
NEIGHBOURS = (
    "GNU Free Documentation License 1.3", "Microsoft Public License", "Python Software Foundation License 2.0", "Academic Free License 3.0", "Server Side Public License 1", "Business Source License 1.1", "Elastic License 2.0", "Common Public License 1.0", "Open Software License 3.0", "Creative Commons Sampling Plus 1.0", "Creative Commons", "Open Database License 1.0", "Apache License 1.0", "GPL-1.0", "Artistic License 1.0", "Q Public License 1.0", "PostgreSQL License", "OpenSSL License", "Ruby License", "W3C Software Notice and License", "Mulan PSL v2", "Affero General Public License 1.0", "CeCILL 2.1", "IBM Public License 1.0", "Apple Public Source License 2.0", "Sun Public License", "European Union Public Licence 1.0", "CC BY 1.0", "CC BY-SA 2.5", "OpenRAIL-M license", "Llama Community License", "Commons Clause", "Vim License", "PHP License 3.01", "SSPL-1.0", "BUSL-1.1", "NCSA Open Source License", "MS-PL", "PSF-2.0", "AFL-3.0", "ODbL-1.0",
)
OTHERS = (
    "a driving licence is required to rent a car", "the license plate of the car was found near the river", "he gave his permission to visit the public library free of charge", "the general spoke to the public about the version of events", "copyright law was discussed at the conference", "the software was released in version 2.0 with many changes",
    "the apache helicopter landed near the mozilla office", "the lesser known MIT students met the creative team", "all conditions of use and redistribution are explained on the next page", "the restaurant lost its liquor license after an inspection", "licensed teachers work under the supervision of the school", "this work is in the public domain of knowledge",
    "released under pressure the documents were published by the foundation", "fishing licenses are sold at the counter, free of charge", "licensed under the terms agreed with the publisher", "please read the license before you install the software", "see the license for details", "a copy of the license was lost", "she studied physics at MIT and worked at Stanford",
    "researchers from MIT and Harvard", "the MIT Media Lab opened", "a professor at MIT said", "MIT graduates earn more", "the eclipse was seen in the north", "a solar eclipse in version of the myth", "boost your sales with our software", "the boost in 2.0 was large", "the gnu is an antelope", "a herd of gnu crossed the river", "apache 2.0 litre engine", "the apache tribe lived in 1.1 million acres", "please CC me by mail", "CC the team by 4.0 pm",
    "artistic freedom in 2.0 days", "the artistic director said", "the creative commons of the village", "attribution of the painting is uncertain", "the attribution by 3.0 experts", "permission to use the car was granted by the owner", "permission is granted to visitors", "run the server on BSD or linux", "install it on FreeBSD 3", "the BSD family of systems", "Apache 2 web server configuration", "apache version 2.4 is installed", "restart apache 2", "apache hadoop 2.0 cluster", "apache spark 3.0 and apache hive 2.0", "apache tomcat 2 server", "an apache module 2.0", "the apache foundation", "the mozilla browser version 2.0", "mozilla foundation announced version 1.1", "the european union public debate", "zlib is used for compression", "link with zlib 1.2", "the zlib library", "uses zlib streams", "BSD sockets are portable", "BSD and linux kernels", "MIT, Caltech and Princeton", "Oxford, MIT, and others", "MIT", "the gpl debate of the nineties", "GNU make and gnu tar", "compress with zlib", "copyright 2020 Someone", "copyright notice", "the unauthorized copying of art", "unauthorized use was reported", "license agreement", "end user license agreement", "the LICENSE file", "license:", "SPDX-License-Identifier:", "choose a license", "see LICENSE", "all rights were reserved for the members", "the ISC conference", "ISC and other bodies met", "the SIL institute", "an open font 1.1",
)
# Words near which n-grams count; those in capitals only count so.
STRONG = frozenset("license licenses licensed licence licences relicensed unlicense unencumbered spdx copyright apache asl apl MIT expat ISC bsd freebsd gnu gpl lgpl agpl affero mozilla mpl eclipse epl eupl artistic boost bsl zlib cddl ofl wtfpl fuck cc0 CC creative attribution sharealike noncommercial noderivatives redistribution redistributions permission waived unauthorized reserved proprietary advertising endorse misrepresented liable anyone".split())
_LETTER = r"[^\W\d_]"


def _tests() -> tuple[list[str], list[tuple[str, re.Pattern]]]:
    """What tells fast whether a lower-case text can hold a strong word: parts that are rare elsewhere, and short words that have to begin a word."""
    parts = {"licen", "alike"} | {w for w in STRONG if w.islower() and len(w) > 5 and "licen" not in w} | {"wtfpl"}
    short = sorted(w for w in STRONG if w.islower() and not any(x in w for x in parts))
    begins = [(w, re.compile(rf"{w}(?<!{_LETTER}{w})")) for w in short]
    return sorted(parts), [*begins, ("commercial", re.compile(r"non[\W_]+commercial")), ("deriv", re.compile(r"no[\W_]+deriv")), ("cc", re.compile(r"cc[\W_]+by"))]


PARTS_OF, BEGINS = _tests()


def may_be(text: str) -> bool:
    """Whether a text can hold a strong word: true for all that do, and false for most others."""
    low = text.lower()
    return any(w in low for w in PARTS_OF) or "MIT" in text or "ISC" in text or "CC" in text or any(w in low and p.search(low) is not None for w, p in BEGINS)


DENYING = frozenset("not no never neither nor cannot without unlike isn't longer incompatible rejected away instead".split())
NUMBERS = {"two": "2", "three": "3", "four": "4", "zero": "0"}
WORD = re.compile(r"cc0|[0-9]+(?:\.[0-9]+)*|[^\W\d_]+", re.IGNORECASE)
PARTS = re.compile(r"[,;()\[\]/|&+]| - |\b(?:and|or|with|but|plus|und|et|ou|oder)\b", re.IGNORECASE)


def words(paragraph: str) -> list[str]:
    """The words in lower case, numbers without an end of ".0" and without a "v" before; MIT, ISC and CC as capitals where they stand for licences."""
    out: list[str] = []
    raw = WORD.findall(paragraph)
    for i, w in enumerate(raw):
        low, after = w.lower(), raw[i + 1].lower() if i + 1 < len(raw) else ""
        if low in ("v", "version", "ver") and after[:1].isdigit():
            continue
        if low[0].isdigit():
            low = re.sub(r"(\.0+)+$", "", low)
            if out and out[-1] in ("gplv", "lgplv", "agplv", "mplv", "eplv", "eplv", "apachev"):
                out[-1] = out[-1][:-1]
        elif w in ("MIT", "ISC", "CC") or (low in ("mit", "isc") and after.startswith("licen")) or (low == "cc" and after == "by"):
            low = low.upper()
        elif low in ("commercial", "derivatives", "derivs", "alike") and out and out[-1] == {"c": "non", "d": "no", "a": "share"}[low[0]]:
            low = {"commercial": "noncommercial", "derivatives": "noderivatives", "derivs": "noderivatives", "alike": "sharealike"}[low]
            out.pop()
        out.append(NUMBERS.get(low, low))
    return out


def ngrams(w: list[str]) -> list[str]:
    """The distinct n-grams of one to three words within three words of a strong one, and whether something is denied there."""
    strong = [i for i, x in enumerate(w) if x in STRONG]
    if not strong:
        return []
    near = set()
    for i in strong:
        near.update(range(max(0, i - 3), min(len(w), i + 4)))
    out = {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1) if i in near and i + n - 1 in near}
    if any(x in DENYING for i in strong for x in w[max(0, i - 6) : i]):
        out.add("(denied)")
    return sorted(out)


def agreement(paragraph: list[str], template: list[str]) -> float:
    """The longest common subsequence of words, as a share of the template."""
    row = [0] * (len(template) + 1)
    for w in paragraph:
        left = 0
        for j, t in enumerate(template):
            left, row[j + 1] = row[j + 1], (left + 1 if w == t else max(row[j + 1], row[j]))
    return row[-1] / len(template)


#: Words of names that distinguish nothing.
PLAIN = frozenset("the a license licence licenses software v version public general only later or international universal dedication domain style".split())


def _distinguishing() -> dict[str, list[tuple[tuple[str, ...], frozenset[str]]]]:
    """Of each family its names as the words that distinguish them, and the words that would make each another family's name."""
    forms = {k: list(dict.fromkeys(tuple(x for x in words(n) if x not in PLAIN) or tuple(words(n)) for n in v)) for k, v in NAMES.items()}
    out = {}
    for k, own in forms.items():
        longer = lambda form, k=k: frozenset(x for other, names in forms.items() if other != k for name in names if set(form) < set(name) for x in set(name) - set(form))
        out[k] = [(form, longer(form)) for form in own]
    return out


NAMED = _distinguishing()
SENTENCES = {k: [words(t) for t in v] for k, v in TEXTS.items()}
#: Words that may stand between and around the words of a name.
SLACK = 5


def names(w: list[str], form: tuple[str, ...], other: frozenset[str]) -> bool:
    """Whether the words of a name stand in order and close together, with nothing beside them that makes it another name."""
    for i, x in enumerate(w):
        if x != form[0]:
            continue
        at, last = 1, i
        for j in range(i + 1, min(len(w), i + len(form) + SLACK)):
            if at < len(form) and w[j] == form[at]:
                at, last = at + 1, j
        if at == len(form) and not other & set(w[max(0, i - 3) : last + 4]):
            return True
    return False


def confirmed(family: str, w: list[str]) -> bool:
    return any(names(w, form, other) for form, other in NAMED.get(family, ())) or any(agreement(w, s) >= MATCH for s in SENTENCES.get(family, ()) if {x for x in s if x[0].isdigit()} <= set(w))


class Model:
    def __init__(self, vocabulary: dict[str, int], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.vocabulary, self.weights, self.bias, self.temperature = vocabulary, weights, bias, temperature
        self.classes = CLASSES

    def probabilities(self, w: list[str]) -> np.ndarray | None:
        """Of each class; None where a paragraph has no features."""
        at = [self.vocabulary[g] for g in ngrams(w) if g in self.vocabulary]
        if not at:
            return None
        z = (self.weights[at].sum(0) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def _one(self, p: np.ndarray, w: list[str]) -> str | None:
        """The family that the classifier is sure of and a template confirms. Versions share a name, so their probabilities support each other."""
        best = int(p.argmax())
        if best == len(CLASSES) - 1:
            return None
        kin = KIN[BASE[CLASSES[best]]]
        if p[kin].sum() < SURE:
            return None
        return next((CLASSES[i] for i in sorted(kin, key=lambda i: -p[i]) if confirmed(CLASSES[i], w)), None)

    def _bare(self, w: list[str]) -> str | None:
        """The family one of whose names these words are."""
        own = tuple(x for x in w if x not in PLAIN)
        return next((k for k, forms in NAMED.items() if any(own == form for form, _ in forms)), None)

    def families(self, paragraph: str) -> tuple[str, ...]:
        """The licences that a paragraph names."""
        w = words(paragraph)
        p = self.probabilities(w)
        if p is None or p[-1] >= SURELY_NONE:
            return ()
        whole = self._one(p, w)
        found = {whole} if whole else set()
        cut = PARTS.split(paragraph)
        denied = False
        for part in cut if len(cut) > 1 else ():
            v = words(part)
            if (q := self.probabilities(v)) is not None and not (denied and whole is None):
                # beside a licence, a part that is nothing but a name is another one
                if one := self._one(q, v) or (whole and self._bare(v)):
                    found.add(one)
            denied = bool(DENYING & set(v)) or (denied and len(v) < 2)
        return tuple(sorted(k for k in found if not any(k != f and BASE[f] == k for f in found)))


#: The family that a versioned one belongs to: its name without the version.
BASE = {k: re.sub(r"-[0-9.]+(-Clause)?$", "", k) for k in [*NAMES, "Proprietary"]}
CLASSES = [*BASE, UNKNOWN]
#: The versions of each such family, as numbers of classes.
KIN = {b: [i for i, c in enumerate(CLASSES[:-1]) if BASE[c] == b] for b in BASE.values()}
#: Families without a version of which there are versions.
VERSIONED = frozenset(k for k in BASE if any(BASE[o] == k != o for o in BASE))


def _filler(r: random.Random, most: int) -> str:
    return " ".join("".join(r.choice("abcdehilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(r.randint(0, most)))


def _invented(r: random.Random) -> str:
    """A licence of no family, by a name made up."""
    name = "".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 3))).capitalize()
    return r.choice((f"{name} Public License {r.randint(1, 4)}.0", f"{name} License", f"{name.upper()}-{r.randint(1, 3)}.{r.randint(0, 2)}", f"{name} Source License, version {r.randint(1, 3)}", f"GNU {name} License", f"Creative {name} License"))


def examples(seed: int, each: int) -> list[tuple[str, str]]:
    """(paragraph, class): names in notices, sentences of the texts with words left out, denials, other licences and prose."""
    r = random.Random(seed)
    framed = lambda text: f"{_filler(r, 5)} {text} {_filler(r, 5)}".strip() if r.random() < 0.5 else text
    put = lambda notice, name: framed(notice.replace("{}", name))
    out = [(put(r.choice(NOTICES), n) if r.random() < 0.8 else n, k) for k, v in NAMES.items() for n in v for _ in range(max(each, each * 6 // len(v)))]
    for k, v in TEXTS.items():
        for t in v:
            for _ in range(each):
                kept = [x for x in t.split(" ") if r.random() > 0.08]
                out.append((framed(" ".join(kept)), k))
    flat = [n for v in NAMES.values() for n in v]
    out += [(put(r.choice(DENIALS), r.choice(flat)), UNKNOWN) for _ in range(60 * each)]
    out += [(put(r.choice(NOTICES), n), UNKNOWN) for n in NEIGHBOURS for _ in range(each)]
    out += [(put(r.choice(NOTICES), _invented(r)), UNKNOWN) for _ in range(60 * each)]
    return out + [(framed(t), UNKNOWN) for t in OTHERS for _ in range(each)]


@lru_cache(1)
def trained(each: int = 12, steps: int = 200, l2: float = 1e-6, seed: int = 5) -> Model:
    """Fits the weights on seeded examples and the temperature on others that are held out."""
    data, held = examples(seed, each), examples(seed + 1, max(2, each // 4))
    seen: dict[str, int] = {}
    grams = [(ngrams(words(p)), k) for p, k in data]
    for g, _ in grams:
        for x in g:
            seen[x] = seen.get(x, 0) + 1
    vocabulary = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n > 2))}
    place = {k: i for i, k in enumerate(CLASSES)}

    def matrix(rows: list[tuple[list[str], str]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(rows), len(vocabulary)), np.float32)
        for i, (g, _) in enumerate(rows):
            x[i, [vocabulary[a] for a in g if a in vocabulary]] = 1
        return x, np.array([place[k] for _, k in rows])

    x, y = matrix(grams)
    w, b = np.zeros((len(vocabulary), len(CLASSES)), np.float32), np.zeros(len(CLASSES), np.float32)
    target = np.eye(len(CLASSES), dtype=np.float32)[y]
    soft = lambda z: (e := np.exp(z - z.max(1, keepdims=True))) / e.sum(1, keepdims=True)
    speed = np.float32(16.0)
    for step in range(steps):
        gap = (soft(x @ w + b) - target) / len(y)
        rate = speed / (1 + step / 200)
        w -= rate * (x.T @ gap + l2 * w)
        b -= rate * gap.sum(0)
    hx, hy = matrix([(ngrams(words(p)), k) for p, k in held])
    z = hx @ w + b
    loss = lambda t: -np.log(soft(z / t)[np.arange(len(hy)), hy] + 1e-12).mean()
    return Model(vocabulary, w, b, float(min(np.geomspace(0.1, 4, 41), key=loss)))


MARK = re.compile(r"[ \t]*(?:<!--|/\*+|\*+/?|//+|#+|--+|;+|%+)?[ \t]*")
LINE = re.compile(r"[^\n]+|(?<=\n)(?=\n)")
_SETS = [(set(w), MATCH * len(w) - (len(w) - len(set(w)))) for v in SENTENCES.values() for w in v]
_FORMS = [frozenset(form) for v in NAMED.values() for form, _ in v]
#: Words after which a stretch of lines is long enough for any template.
STRETCH = 2 * max(len(w) for v in SENTENCES.values() for w in v)


def _possible(have: set[str]) -> bool:
    """Whether a stretch of these words could be confirmed at all: a necessary condition."""
    return any(len(have & t) >= least for t, least in _SETS) or any(form <= have for form in _FORMS)


def licences_of(text: str, predict: Callable[[str], tuple[str, ...]]) -> list[tuple[str, int, int]]:
    """(family, start, end) of the paragraphs that name licences: lines, and stretches of lines that do so only together."""
    if not may_be(text):
        return []
    hits: list[tuple[str, int, int]] = []
    block: list[tuple[int, int, str, bool, tuple[str, ...]]] = []

    def near() -> dict[int, list[str]]:
        """The words of the lines that a stretch with a strong line can hold: those within STRETCH words of one."""
        out: dict[int, list[str]] = {}
        for at in (i for i, x in enumerate(block) if x[3]):
            for way in (range(at, len(block)), range(at, -1, -1)):
                count = 0
                for i in way:
                    if i not in out:
                        out[i] = words(block[i][2])
                    if i != at and (count := count + len(out[i])) >= STRETCH:
                        break
        return out

    def wrapped() -> None:
        begin, told, said = 0, set(), near()
        for end in range(1, len(block)):
            if end not in said:
                continue
            count, seen, some = len(said[end]), set(said[end]), block[end][3]
            for i in range(end - 1, begin - 1, -1):
                if i not in said:
                    break
                count += len(said[i])
                seen.update(said[i])
                some = some or block[i][3]
                if some and _possible(seen):
                    lines = block[i : end + 1]
                    alone = {k for x in lines for k in x[4]}
                    if found := [k for k in predict(" ".join(x[2] for x in lines)) if k not in alone]:
                        hits.extend((k, block[i][0], block[end][1]) for k in found)
                        told.update(range(i, end + 1))
                        begin = end + 1
                        break
                if count >= STRETCH:
                    break
        hits.extend((k, x[0], x[1]) for at, x in enumerate(block) if at not in told for k in x[4])

    for m in LINE.finditer(text):
        line = text[MARK.match(text, m.start(), m.end()).end() : m.end()]
        strong = bool(line) and may_be(line)
        found = predict(line) if strong else ()
        # a family without its version may have it on the next line
        open_end = found if found and all(k in VERSIONED for k in found) else ()
        if line.strip() and found == open_end:
            block.append((m.start(), m.end(), line, strong, open_end))
            continue
        hits.extend((k, m.start(), m.end()) for k in found)
        if any(x[3] for x in block):
            wrapped()
        block = []
    if any(x[3] for x in block):
        wrapped()
    return sorted(hits, key=lambda h: (h[1:], h[0]))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, families (sorted, comma-joined, empty if none), n_paragraphs, spans (family:start:end, comma-joined) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(trained())
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, families string, n_paragraphs long, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = lru_cache(10_000)(model.value.families)
        for batch in batches:
            found = []
            for text in batch.column(1):
                found.append(licences_of(text.as_py(), lambda line: (predict if len(line) < 500 else model.value.families)(line)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([",".join(sorted({h[0] for h in hits})) for hits in found], pa.string()),
                    pa.array([len(hits) for hits in found], pa.int64()),
                    pa.array([",".join([f"{k}:{a}:{b}" for k, a, b in hits]) for hits in found], pa.string()),
                ],
                names=["doc_id", "families", "n_paragraphs", "spans"],
            )

    return in_small_batches(rows).mapInArrow(run, schema)
