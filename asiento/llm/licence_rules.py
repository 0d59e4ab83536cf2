"""The sentences of well-known public licences, and the order they come in.

``SENTENCES`` gives the wordings of each sentence identifier; several wordings (parties, program or
library) may share one. ``RULES`` gives, for each licence, the sequences of identifiers that
tell it. A sequence that ends early is a rule of its own where its beginning tells the licence already.
"""

from __future__ import annotations

FSF = "{thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, "
FSF_KINDS = {"gpl": "", "lgpl": "Lesser ", "agpl": "Affero "}
THINGS = ("This program", "This library", "This software", "This file")
HOLDERS = ("the copyright holder", "the copyright holders", "the author", "the University", "the Regents")
GIVERS = ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS", "THE AUTHOR AND CONTRIBUTORS", "THE AUTHORS AND CONTRIBUTORS", "THE AUTHOR")
LIABLE = ("THE COPYRIGHT HOLDER OR CONTRIBUTORS", "THE COPYRIGHT OWNER OR CONTRIBUTORS", "COPYRIGHT HOLDERS OR CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS", "THE AUTHOR OR CONTRIBUTORS", "THE AUTHORS OR CONTRIBUTORS", "THE AUTHOR")
CC_KINDS = {
    "CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial",
    "CC-BY-ND-4.0": "Attribution-NoDerivatives", "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
}

SENTENCES: dict[str, str | tuple[str, ...]] = {
    "rights": "All rights reserved.",
    # MIT and its kin
    "mit-notice": ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."),
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "ncsa-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notices": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "x11-liability": "IN NO EVENT SHALL THE X CONSORTIUM BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "x11-names": "Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium.",
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "isc-liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    # BSD
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Redistributions of source code must retain the above copyright notice, this list of conditions, and the following disclaimer;"),
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-acknowledge": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd-product": ("This product includes software developed by the University of California, Berkeley and its contributors.", "This product includes software developed by the copyright holder."),
    "bsd-names": tuple(f"Neither the name of {who} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission." for who in HOLDERS),
    "bsd-warranty": tuple(f"THIS SOFTWARE IS PROVIDED BY {who} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED." for who in GIVERS),
    "bsd-liability": tuple(f"IN NO EVENT SHALL {who} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE." for who in LIABLE),
    # Apache
    "apache2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache2-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "copy-at": "You may obtain a copy of the License at",
    "apache2-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License.",
    # GNU
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gnu-hope": tuple(f"{thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE." for thing in THINGS),
    "gnu-url": ("If not, see http://www.gnu.org/licenses/.", "If not, see http://www.gnu.org/licenses."),
    # others
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-url": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "epl1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    "cc0-extent": tuple(f"To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this {thing} to the public domain worldwide." for thing in ("software", "work")),
    "cc0-warranty": "This software is distributed without any warranty.",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    "zlib-product": "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "zlib-notice": "This notice may not be removed or altered from any source distribution.",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "wtfpl-terms": "You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as published by Sam Hocevar.",
    "ofl-notice": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "perl-terms": tuple(f"{thing} is free software; you can redistribute it and/or modify it under the same terms as Perl itself." for thing in THINGS),
    "cddl-subject": "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\").",
    "cddl-comply": "You may not use this file except in compliance with the License.",
    "mspl-subject": "This source code is subject to the Microsoft Public License.",
    "mulan-terms": "You can use this software according to the terms and conditions of the Mulan PSL v2.",
}

for _kind, _name in FSF_KINDS.items():
    for _version in {"gpl": ("2", "3"), "lgpl": ("2.1", "3"), "agpl": ("3",)}[_kind]:
        _id = f"{_kind}{_version.replace('.', '')}"
        SENTENCES[f"{_id}-terms"] = tuple(FSF.format(thing=t, kind=_name) + f"either version {_version} of the License, or (at your option) any later version." for t in THINGS)
        SENTENCES[f"{_id}-only"] = tuple(FSF.format(thing=t, kind=_name) + f"version {_version} of the License." for t in THINGS)
    SENTENCES[f"{_kind}-see"] = f"See the GNU {_name}General Public License for more details."
    SENTENCES[f"{_kind}-copy"] = tuple(f"You should have received a copy of the GNU {_name}General Public License along with {t.lower()}." for t in THINGS)
for _licence, _name in CC_KINDS.items():
    SENTENCES[_licence.replace(".", "").lower()] = (
        f"Licensed under CC {_licence[3:].replace('-4.0', ' 4.0')}.", f"This work is licensed under a Creative Commons {_name} 4.0 International License.",
        f"This work is licensed under the Creative Commons {_name} 4.0 International License.",
    )


def prefixes(least: int, *names: str) -> list[list[str]]:
    """The sequence and its beginnings of at least ``least`` sentences."""
    return [list(names[:n]) for n in range(least, len(names) + 1)]


def _gnu(kind: str, version: str) -> list[list[str]]:
    rest = ("gnu-hope", f"{kind}-see", f"{kind}-copy", "gnu-url")
    return [rule for form in ("terms", "only") for rule in prefixes(1, f"{kind}{version}-{form}", *rest)]


_BSD = ("bsd-grant", "bsd-source", "bsd-binary")
_END = ("bsd-warranty", "bsd-liability")

RULES: dict[str, list[list[str]]] = {
    "All-rights-reserved": [["rights"]],
    "MIT": [["mit-notice"], *prefixes(3, "mit-grant", "mit-notices", "mit-warranty", "mit-liability")],
    "MIT-0": prefixes(2, "mit0-grant", "mit-warranty", "mit-liability"),
    "X11": [["mit-grant", "mit-notices", "mit-warranty", "x11-liability", "x11-names"], ["mit-grant", "mit-notices", "mit-warranty", "mit-liability", "x11-names"]],
    "NCSA": [["ncsa-grant"]],
    "ISC": prefixes(2, "isc-grant", "isc-warranty", "isc-liability"),
    "0BSD": prefixes(2, "0bsd-grant", "isc-warranty", "isc-liability"),
    "PostgreSQL": [["postgresql-grant"]],
    "BSD-2-Clause": prefixes(3, *_BSD, *_END),
    "BSD-3-Clause": prefixes(4, *_BSD, "bsd-names", *_END),
    "BSD-4-Clause": prefixes(6, *_BSD, "bsd-acknowledge", "bsd-product", "bsd-names", *_END),
    "Apache-2.0": [["apache2-notice"], *prefixes(1, "apache2-grant", "copy-at", "apache2-url", "apache2-warranty", "apache2-see")],
    "GPL-2.0": _gnu("gpl", "2"),
    "GPL-3.0": [["gpl3-notice"], *_gnu("gpl", "3")],
    "LGPL-2.1": _gnu("lgpl", "21"),
    "LGPL-3.0": _gnu("lgpl", "3"),
    "AGPL-3.0": _gnu("agpl", "3"),
    "MPL-2.0": prefixes(1, "mpl2-subject", "mpl2-url"),
    "EPL-1.0": [["epl1-terms"]],
    "EPL-2.0": [["epl2-terms"]],
    "CC0-1.0": prefixes(1, "cc0-extent", "cc0-warranty"),
    **{licence: [[licence.replace(".", "").lower()]] for licence in CC_KINDS},
    "Zlib": prefixes(3, "zlib-warranty", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-product", "zlib-altered", "zlib-notice"),
    "BSL-1.0": [["boost-notice"], ["boost-grant"]],
    "Unlicense": prefixes(1, "unlicense-free", "unlicense-anyone"),
    "WTFPL": [["wtfpl-terms"]],
    "OFL-1.1": [["ofl-notice"]],
    "Perl": [["perl-terms"]],
    "CDDL-1.0": prefixes(1, "cddl-subject", "cddl-comply"),
    "MS-PL": [["mspl-subject"]],
    "MulanPSL-2.0": [["mulan-terms"]],
}

# The one-line tag of source files, for every licence.
for _licence in [name for name in RULES if name not in ("All-rights-reserved", "Perl")]:
    _tag = "spdx-" + _licence.replace(".", "").lower()
    _names = (_licence, *(f"{_licence}{end}" for end in ("-only", "-or-later") if "GPL" in _licence))
    SENTENCES[_tag] = tuple(f"SPDX-License-Identifier: {name}" for name in _names)
    RULES[_licence].append([_tag])
