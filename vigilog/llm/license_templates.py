"""Public licence notices and licences, as templates for the scan."""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator
from dataclasses import dataclass


@dataclass(frozen=True)
class Template:
    """``needed``: words without which the text is another licence, however alike the rest is.

    ``excluded``: words that make it another licence; a find holds none of them. ``exact``: no
    other word may stand between those of the template.
    """

    license: str
    kind: str
    text: str
    needed: tuple[str, ...]
    excluded: tuple[str, ...] = ()
    exact: bool = False


def _full(name: str) -> str:
    """A whole licence from the folder beside this module."""
    return pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()


# Words by which notices of one family differ.
_NC, _SA, _ND = ("nc", "noncommercial", "commercial"), ("sa", "sharealike", "alike"), ("nd", "noderivatives", "noderivs", "derivatives", "derivs")
_GNU = "{0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version."
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_ADVERTISING = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. "
_NEITHER = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)

# Licences by identifier, with the names that one-line notices use for them.
_NAMED = {
    ("MIT", "permissive"): ("MIT License", "MIT licence", "MIT"),
    ("Apache-2.0", "permissive"): ("Apache License 2.0", "Apache License v2.0", "Apache License version 2.0", "Apache 2.0", "Apache 2.0 License", "Apache-2.0"),
    ("BSD-2-Clause", "permissive"): ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    ("BSD-3-Clause", "permissive"): ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    ("ISC", "permissive"): ("ISC License",),
    ("MPL-2.0", "weak copyleft"): ("Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPL-2.0"),
    ("Unlicense", "public domain"): ("Unlicense",),
    ("CC0-1.0", "public domain"): ("CC0", "CC0 1.0", "CC0 1.0 Universal"),
}
_LEADS = ("licensed", "released", "distributed", "available", "published")
_TERMS = ("under", "under the", "under the terms of the")
# The GNU family by short name, with the versions there are.
_FAMILY = {
    ("GPL", "copyleft", "General"): ("1", "2", "3"),
    ("LGPL", "weak copyleft", "Lesser General"): ("2.1", "3"),
    ("AGPL", "network copyleft", "Affero General"): ("3",),
}
# Further identifiers of SPDX lines.
_SPDX = {
    "permissive": ("0BSD", "MIT-0", "Zlib", "BSL-1.0", "Apache-1.1", "BSD-4-Clause", "PostgreSQL", "Python-2.0"),
    "weak copyleft": ("LGPL-2.0-only", "LGPL-2.0-or-later", "MPL-1.1", "EPL-1.0", "EPL-2.0", "CDDL-1.0"),
    "attribution": ("CC-BY-4.0", "CC-BY-3.0"),
    "share-alike": ("CC-BY-SA-4.0", "CC-BY-SA-3.0"),
    "no derivatives": ("CC-BY-ND-4.0",),
    "non-commercial": ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"),
}


def _line(license: str, kind: str, text: str) -> Template:
    """A notice of one line, of which every word counts."""
    return Template(license, kind, text, tuple(text.lower().replace("-", " ").replace(":", " ").split()), exact=True)


def _one_line() -> Iterator[Template]:
    """Usual wordings of one line: a lead and a name, short GNU names, and SPDX lines.

    Names of other than the GNU family need a lead: "MIT" alone is no notice.
    """
    spdx = [(name, name, kind) for kind, names in _SPDX.items() for name in names]
    for (license, kind), names in _NAMED.items():
        spdx.append((license, license, kind))
        for name in names:
            yield from (_line(license, kind, f"{lead} {terms} {name}") for lead in _LEADS for terms in _TERMS)
    for (short, kind, long), versions in _FAMILY.items():
        for version in versions:
            full = version if "." in version else f"{version}.0"
            license = f"{short}-{full}"
            spdx += [(license + end, license, kind) for end in ("", "-only", "-or-later")]
            for number in {version, full}:
                yield from (_line(license, kind, name) for name in (f"GNU {short} v{number}", f"GNU {short} {number}", f"GNU {short} version {number}", f"{short}v{number}"))
                yield from (_line(license, kind, f"{lead} {terms} {short} {v}{number}") for lead in _LEADS for terms in _TERMS for v in ("", "v", "version "))
                yield from (_line(license, kind, f"GNU {long} Public License {v}{number}") for v in ("", "v", "version "))
    for name, license, kind in spdx:
        yield _line(license, kind, f"SPDX-License-Identifier: {name}")


# Wordings as published by their licences' stewards, and usual one-line notices.
TEMPLATES = (
    Template("MIT", "permissive", "Released under the MIT License.", ("mit",)),
    Template("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0.", ("apache", "2.0")),
    Template("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3.", ("gnu", "general", "3"), ("affero", "lesser", "library")),
    Template("CC-BY-NC-4.0", "non-commercial", "Licensed under CC BY-NC 4.0.", ("cc", "by", "nc", "4.0"), _SA + _ND),
    Template("CC-BY-4.0", "attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("attribution", "4.0"), _NC + _SA + _ND),
    Template("CC-BY-SA-4.0", "share-alike", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ("sharealike", "4.0"), _NC + _ND),
    Template("MPL-2.0", "weak copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "2.0")),
    Template(
        "MIT", "permissive",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software.",
        ("sublicense", "hereby"),
    ),
    Template(
        "ISC", "permissive",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("fee", "hereby"),
    ),
    Template(
        "BSD-2-Clause", "permissive",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
        "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        ("redistribution", "binary"),
    ),
    Template(
        "Apache-2.0", "permissive",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        ("apache", "2.0"),
    ),
    Template(
        "GPL-3.0", "copyleft",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
        ("gnu", "3"), ("affero", "lesser"),
    ),
    Template("All-Rights-Reserved", "proprietary", "All rights reserved.", ("all", "rights", "reserved"), exact=True),
    Template("GPL-2.0", "copyleft", _GNU.format("This program", ";", "", ";", "2"), ("gnu", "2"), ("affero", "lesser")),
    Template("GPL-2.0", "copyleft", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", ("gnu", "2"), ("affero", "lesser", "either")),
    Template("LGPL-2.0", "weak copyleft", _GNU.format("This library", ";", "Library ", ";", "2"), ("gnu", "library", "2"), ("affero", "lesser")),
    Template("LGPL-2.1", "weak copyleft", _GNU.format("This library", ";", "Lesser ", ";", "2.1"), ("lesser", "2.1")),
    Template("LGPL-3.0", "weak copyleft", _GNU.format("This library", ":", "Lesser ", ",", "3"), ("lesser", "3")),
    Template("AGPL-3.0", "network copyleft", _GNU.format("This program", ":", "Affero ", ",", "3"), ("affero", "3")),
    Template("LGPL-3.0", "weak copyleft", "This work is licensed under the GNU Lesser General Public License, version 3.", ("gnu", "lesser", "3")),
    Template("LGPL-2.1", "weak copyleft", "This work is licensed under the GNU Lesser General Public License, version 2.1.", ("gnu", "lesser", "2.1")),
    Template("AGPL-3.0", "network copyleft", "This work is licensed under the GNU Affero General Public License, version 3.", ("gnu", "affero", "3")),
    Template("AGPL-3.0", "network copyleft", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ("affero", "3", "2007")),
    Template("CC-BY-4.0", "attribution", "Licensed under CC BY 4.0.", ("cc", "by", "4.0"), _NC + _SA + _ND),
    Template("CC-BY-SA-4.0", "share-alike", "Licensed under CC BY-SA 4.0.", ("cc", "by", "sa", "4.0"), _NC + _ND),
    Template("CC-BY-ND-4.0", "no derivatives", "Licensed under CC BY-ND 4.0.", ("cc", "by", "nd", "4.0"), _NC + _SA),
    Template("CC-BY-NC-SA-4.0", "non-commercial", "Licensed under CC BY-NC-SA 4.0.", ("cc", "by", "nc", "sa", "4.0"), _ND),
    Template("CC-BY-NC-ND-4.0", "non-commercial", "Licensed under CC BY-NC-ND 4.0.", ("cc", "by", "nc", "nd", "4.0"), _SA),
    Template("CC-BY-NC-4.0", "non-commercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ("noncommercial", "4.0"), _SA + _ND),
    Template("CC-BY-ND-4.0", "no derivatives", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ("noderivatives", "4.0"), _NC + _SA),
    Template("CC-BY-NC-SA-4.0", "non-commercial", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", ("noncommercial", "sharealike", "4.0"), _ND),
    Template("CC-BY-NC-ND-4.0", "non-commercial", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", ("noncommercial", "noderivatives", "4.0"), _SA),
    Template("BSD-3-Clause", "permissive", _BSD + _NEITHER, ("redistribution", "neither", "endorse"), ("advertising",)),
    Template("BSD-4-Clause", "permissive", _BSD + _ADVERTISING + _NEITHER, ("redistribution", "advertising", "neither")),
    Template("CC0-1.0", "public domain", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.", ("cc0", "waived")),
    Template(
        "Unlicense", "public domain",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        ("unencumbered", "public", "domain"),
    ),
    *_one_line(),
    # Whole licences.
    Template("Apache-2.0", "permissive", _full("Apache-2.0"), ("apache", "2.0")),
    Template("CC0-1.0", "public domain", _full("CC0-1.0"), ("cc0",)),
    Template("GPL-2.0", "copyleft", _full("GPL-2"), ("gnu", "1991")),
    Template("GPL-3.0", "copyleft", _full("GPL-3"), ("gnu", "2007"), ("remotely",)),
    Template("LGPL-2.0", "weak copyleft", _full("LGPL-2"), ("gnu", "library"), ("lesser",)),
    Template("LGPL-2.1", "weak copyleft", _full("LGPL-2.1"), ("gnu", "lesser", "2.1")),
    Template("LGPL-3.0", "weak copyleft", _full("LGPL-3"), ("gnu", "lesser", "3")),
    Template("MPL-2.0", "weak copyleft", _full("MPL-2.0"), ("mozilla", "2.0")),
)
