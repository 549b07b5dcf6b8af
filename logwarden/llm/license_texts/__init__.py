"""Whole licence texts, one file for each SPDX id, with the usual variants of heading and wording."""

from __future__ import annotations

import re
from pathlib import Path

# Headings that stand above a licence; "" is none.
HEADINGS = {
    "MIT": ("", "MIT", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "(The MIT License)"),
    "ISC": ("", "ISC", "ISC License", "The ISC License", "The ISC License (ISC)", "ISC License (ISC)"),
    "BSD-3-Clause": (
        "", "BSD License", "The BSD License", "BSD 3-Clause License", "The BSD 3-Clause License", "BSD-3-Clause",
        "The 3-Clause BSD License", "3-Clause BSD License", "New BSD License", "The New BSD License",
        "Modified BSD License", "BSD 3-Clause \"New\" or \"Revised\" License",
    ),
    "BSD-2-Clause": (
        "", "BSD License", "The BSD License", "BSD 2-Clause License", "The BSD 2-Clause License", "BSD-2-Clause",
        "The 2-Clause BSD License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License",
        "BSD 2-Clause \"Simplified\" License",
    ),
    "CC0-1.0": ("Creative Commons Legal Code\n\nCC0 1.0 Universal", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", ""),
    "Apache-2.0": (
        "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/",
        "Apache License\nVersion 2.0, January 2004", "Apache License 2.0", "",
    ),
}
# The line under which copies stop that do without what follows the terms.
_TAIL = re.compile(r"(?m)^.*(?:APPENDIX: How to apply|How to Apply These|END OF TERMS AND|Exhibit A - Source).*$")
_FIRST_LINES = {"Apache-2.0": "   TERMS AND CONDITIONS", "CC0-1.0": "    CREATIVE COMMONS CORPORATION"}


def _text(name: str) -> str:
    return (Path(__file__).parent / f"{name}.txt").read_text(encoding="utf-8")


def _bsd() -> list[tuple[str, str]]:
    """The 3- and 2-clause texts: numbered or with bullets, of the university or of any holder."""
    base = _text("BSD-3-Clause")
    base = base[base.index("Redistribution and use"):]
    any_holder = base.replace("Neither the name of the University", "Neither the name of the copyright holder")
    any_holder = any_holder.replace("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS")
    any_holder = any_holder.replace("THE REGENTS OR CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS")
    owner = any_holder.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR")
    holders = any_holder.replace("COPYRIGHT HOLDER OR", "COPYRIGHT HOLDERS OR")
    texts = []
    for body in (base, any_holder, owner, holders):
        # some copies say "the names of contributors"
        for said in (body, body.replace("nor the names of its", "nor the names of")):
            without = re.sub(r"(?s)3\. Neither.*?permission\.\n", "", said)
            for numbered in (said, re.sub(r"(?m)^\d\. ", "* ", said)):
                texts.append(("BSD-3-Clause", numbered))
            for numbered in (without, re.sub(r"(?m)^\d\. ", "* ", without)):
                texts.append(("BSD-2-Clause", numbered))
    return list(dict.fromkeys(texts))


def whole_texts(short: dict[str, str]) -> list[tuple[str, str]]:
    """``(license, text)`` of all variants; ``short`` has the texts of MIT and ISC under one line of heading."""
    bodies = [(name, text.split("\n", 1)[1]) for name, text in short.items()]
    bodies += [(n, t.replace("modify, and/or distribute", "modify, and distribute")) for n, t in bodies if n == "ISC"]
    bodies += _bsd()
    for path in sorted(Path(__file__).parent.glob("*.txt")):
        name, text = path.stem, _text(path.stem)
        if name == "BSD-3-Clause":
            continue
        if name in _FIRST_LINES:
            text = text[text.index(_FIRST_LINES[name]):]
        bodies += [(name, text)]
        for tail in _TAIL.finditer(text):
            bodies += [(name, text[:tail.start()])]
    out = [(name, f"{heading}\n\n{body}") for name, body in bodies for heading in HEADINGS.get(name, ("",))]
    out += [(name, text.replace("http://", "https://")) for name, text in out]
    out += [(name, text.replace("https://", "http://")) for name, text in out]
    return list(dict.fromkeys(out))
