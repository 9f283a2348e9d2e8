"""Texts by which licenses are known.  What stands in braces tells a license from its kin.

A name may have several texts: a line that refers to the license, its usual notice, its full
text where that is short, the heading of its full text where that is long.
"""

from __future__ import annotations

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met"
)
_BSD_2 = (
    _BSD + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials {provided with the distribution}. "
)
_NEITHER = (
    "{Neither the name of} the copyright holder nor the names of its contributors may be used to {endorse or promote products "
    "derived from this software} without specific prior written permission. "
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction"
)
_MIT_RIGHTS = (
    ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is "
)
_MIT_AS_IS = (
    " IS PROVIDED} \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose {with or without fee is hereby granted"


def _gnu(program: str, name: str, version: str) -> str:
    return (f"This {program} is free software: you can redistribute it and/or modify it under the terms of the {{GNU "
            f"{name}}} as published by the Free Software Foundation, either {{version {version} of}} the License, or (at "
            "your option) any later version.")


def _gnu_line(name: str, version: str) -> str:
    return f"This work is licensed under the {{GNU {name}}}, {{version {version}}}."


TEMPLATES: dict[str, str | tuple[str, ...]] = {
    "Apache-2.0-line": "Licensed under the {Apache License}, {Version 2.0}.",
    "Apache-2.0": "Licensed under the {Apache License}, {Version 2.0} (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-text": "{Apache License Version 2.0}, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
    "USE, REPRODUCTION, AND DISTRIBUTION",
    "MIT-line": "Released under the {MIT License}.",
    "MIT": (
        _MIT,
        _MIT + _MIT_RIGHTS + "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "{permission notice shall be included} in all copies or substantial portions of the Software. {THE SOFTWARE" + _MIT_AS_IS,
    ),
    "MIT-0": _MIT + _MIT_RIGHTS + "{furnished to do so. THE SOFTWARE" + _MIT_AS_IS,
    "GPL-3.0-line": _gnu_line("General Public License", "3"),
    "GPL-3.0": (
        _gnu("program", "General Public License", "3"),
        "{GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007} Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "GPL-2.0-line": _gnu_line("General Public License", "2"),
    "GPL-2.0": (
        _gnu("program", "General Public License", "2"),
        "{GNU GENERAL PUBLIC LICENSE Version 2, June 1991} Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    ),
    "LGPL-2.1-line": _gnu_line("Lesser General Public License", "2.1"),
    "LGPL-2.1": (
        _gnu("library", "Lesser General Public License", "2.1"),
        "{GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999} Copyright (C) 1991, 1999 Free Software Foundation, Inc.",
    ),
    "LGPL-3.0-line": _gnu_line("Lesser General Public License", "3"),
    "LGPL-3.0": (
        _gnu("program", "Lesser General Public License", "3"),
        "{GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007} Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "AGPL-3.0-line": _gnu_line("Affero General Public License", "3"),
    "AGPL-3.0": (
        _gnu("program", "Affero General Public License", "3"),
        "{GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007} Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "BSD-line": "Released under the {BSD License}.",
    "BSD-2-Clause-line": ("Released under the {BSD 2-Clause License}.", "Released under the {2-Clause BSD License}."),
    "BSD-3-Clause-line": ("Released under the {BSD 3-Clause License}.", "Released under the {3-Clause BSD License}."),
    "BSD": _BSD,
    "BSD-2-Clause": _BSD_2.replace("distribution}. ", "distribution. THIS SOFTWARE IS PROVIDED}") + _AS_IS[len("THIS SOFTWARE IS PROVIDED"):],
    "BSD-3-Clause": _BSD_2 + "3. " + _NEITHER + _AS_IS,
    "BSD-4-Clause": _BSD_2 + "3. {All advertising materials mentioning features or use} of this software must display the following "
    "acknowledgement: This product includes software developed by the organization. 4. " + _NEITHER + _AS_IS,
    "ISC-line": "Released under the {ISC License}.",
    "ISC": _USE + ", provided that the above copyright notice} and this permission notice appear in all copies.",
    "0BSD": _USE + ". THE SOFTWARE IS PROVIDED} \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
    "any purpose, including commercial applications, and to {alter it and redistribute it freely}, subject to the following restrictions",
    "BSL-1.0-line": "Distributed under the {Boost Software License}, {Version 1.0}.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}.",
    "MPL-2.0-line": "Licensed under the {Mozilla Public License, Version 2.0}.",
    "MPL-1.1": "The contents of this file are subject to the {Mozilla Public License Version 1.1} (the \"License\"); you may not use "
    "this file except in compliance with the License.",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the {Eclipse Public License v1.0}",
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the {Eclipse Public License 2.0}",
        "This program and the accompanying materials are made available under the terms of the {Eclipse Public License v2.0}",
    ),
    "Unlicense": "This is {free and unencumbered software} released into the public domain.",
    "CC0-1.0": (
        "Licensed under {CC0 1.0}.",
        "To the extent possible under law, the author has {waived all copyright} and related or neighboring rights to this work.",
        "This work is licensed under a {Creative Commons CC0 1.0} Universal License.",
    ),
}


def _creative_commons() -> dict[str, tuple[str, ...]]:
    out = {}
    full = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial"}
    apart = {"BY": "Attribution", "SA": "Share Alike", "NC": "Non Commercial", "ND": "No Derivatives"}
    for version, port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic")):
        for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
            marks = kind.split("-")
            names = ["-".join(d.get(m, nd) for m in marks) for d in (full, apart) for nd in ("NoDerivatives", "NoDerivs")]
            out[f"CC-{kind}-{version}"] = (f"Licensed under {{CC {kind} {version}}}.",) + tuple(
                f"This work is licensed under a {{Creative Commons {n} {version}}} {port} License." for n in dict.fromkeys(names))
    return out


TEMPLATES |= _creative_commons()
