"""Fixed values of the check statement: whole licence texts, typed apart from the operator's sentences.

Each entry is a licence, the words that tell it, and what may follow; every "..." mark separates a text
that may end there. ``[a|b]`` stands for one of several words. Only the check statement reads this.
"""

from __future__ import annotations

import re

_GNU_REST = """... [This program|This library|This software|This file] is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. ... See the GNU %(kind)sGeneral Public
License for more details. ... You should have received a copy of the GNU %(kind)sGeneral Public License along with
[this program|this library|this software|this file]. ... If not, see [http://www.gnu.org/licenses/|http://www.gnu.org/licenses]."""
_GNU_ANY = """[This program|This library|This software|This file] is free software; you can redistribute it and/or modify it under the terms of the
GNU %(kind)sGeneral Public License as published by the Free Software Foundation; either version %(v)s of the License, or (at your option) any later version. """ + _GNU_REST
_GNU_ONLY = """[This program|This library|This software|This file] is free software; you can redistribute it and/or modify it under the terms of the
GNU %(kind)sGeneral Public License as published by the Free Software Foundation; version %(v)s of the License. """ + _GNU_REST
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal %s the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_NO_EVENT = """IN NO EVENT SHALL %s BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT_BODY = _MIT_GRANT % "in" + """, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. """ + _AS_IS
_X_NAMES = """ Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale,
use or other dealings in this Software without prior written authorization from the X Consortium."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. ... IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""
_BSD_NAMES = """ Neither the name of [the copyright holder|the copyright holders|the author|the University|the Regents] nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """ ... THIS SOFTWARE IS PROVIDED BY [THE COPYRIGHT HOLDERS AND CONTRIBUTORS|THE REGENTS AND CONTRIBUTORS|THE AUTHOR AND CONTRIBUTORS|THE
AUTHORS AND CONTRIBUTORS|THE AUTHOR] "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. ... IN NO EVENT SHALL [THE COPYRIGHT HOLDER OR CONTRIBUTORS|THE COPYRIGHT OWNER OR
CONTRIBUTORS|COPYRIGHT HOLDERS OR CONTRIBUTORS|THE REGENTS OR CONTRIBUTORS|THE AUTHOR OR CONTRIBUTORS|THE AUTHORS OR CONTRIBUTORS|THE AUTHOR] BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_CC = "Licensed under CC %s 4.0.", "This work is licensed under [a|the] Creative Commons %s 4.0 International License."

TEXTS: list[tuple[str, str]] = [
    ("All-rights-reserved", "All rights reserved."),
    ("MIT", "[Released|Licensed|This project is licensed] under the MIT License."),
    ("MIT", _MIT_BODY + " ... " + _NO_EVENT % "THE AUTHORS OR COPYRIGHT HOLDERS"),
    ("MIT-0", _MIT_GRANT % "in" + ". " + _AS_IS + " ... " + _NO_EVENT % "THE AUTHORS OR COPYRIGHT HOLDERS"),
    ("X11", _MIT_BODY + " " + _NO_EVENT % "[THE X CONSORTIUM|THE AUTHORS OR COPYRIGHT HOLDERS]" + _X_NAMES),
    ("NCSA", _MIT_GRANT % "with" + ", subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, [and/or|and] distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_END),
    ("PostgreSQL", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_END),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_END),
    ("BSD-4-Clause", _BSD_HEAD + " All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by [the University of California, Berkeley and its contributors|the copyright holder]." + _BSD_NAMES + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. ... You may
obtain a copy of the License at ... http://www.apache.org/licenses/LICENSE-2.0 ... Unless required by applicable law or agreed to in writing, software distributed
under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. ... See the License for the
specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    *((licence, form % {"kind": kind, "v": version}) for form in (_GNU_ANY, _GNU_ONLY) for licence, kind, version in (
        ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. ... If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this [software|work] to the public domain worldwide. ... This software is distributed without any warranty."),
    *((licence, text % words) for licence, short, long in (
        ("CC-BY-4.0", "BY", "Attribution"), ("CC-BY-SA-4.0", "BY-SA", "Attribution-ShareAlike"), ("CC-BY-NC-4.0", "BY-NC", "Attribution-NonCommercial"),
        ("CC-BY-ND-4.0", "BY-ND", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("CC-BY-NC-ND-4.0", "BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) for text, words in zip(_CC, (short, long))),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from
the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions: ... The origin of this software must not be misrepresented; you must not claim that you wrote the original software. ...
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. ... Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. ... This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
third-parties to whom the Software is furnished to do so, all subject to the following:"""),
    ("Unlicense", "This is free and unencumbered software released into the public domain. ... Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("WTFPL", "You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as published by Sam Hocevar."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("Perl", "[This program|This library|This software|This file] is free software; you can redistribute it and/or modify it under the same terms as Perl itself."),
    ("CDDL-1.0", 'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License"). ... You may not use this file except in compliance with the License.'),
    ("MS-PL", "This source code is subject to the Microsoft Public License."),
    ("MulanPSL-2.0", "You can use this software according to the terms and conditions of the Mulan PSL v2."),
]


def _plain(words: str) -> str:
    return re.sub("[^0-9a-z]+", " ", words.lower()).strip()


def _pattern(text: str) -> tuple[str, str]:
    """A text's longest run of fixed words, and its pattern: a line feed before and after each sentence, blanks or line feeds between words."""
    sentences, fixed = [], []
    for sentence in re.split(r"(?<=[.!?:])\s+", text):
        cut = re.split(r"\[([^\]]*\|[^\]]*)\]", sentence)
        parts = ["(?:" + "|".join(map(_plain, part.split("|"))) + ")" if k % 2 else _plain(part) for k, part in enumerate(cut)]
        fixed += parts[::2]
        sentences.append(" ".join(filter(None, parts)).replace(" ", r"[ \n]"))
    return max(fixed, key=len), r"\n" + r"\n".join(sentences) + r"\n"


def patterns() -> list[tuple[str, str, str]]:
    """Licence, fixed words and pattern of each text and of each place where it may end."""
    found = []
    for licence, text in TEXTS:
        parts = re.split(r"\s*\.\.\.\s+", text)
        found += [(licence, *_pattern(" ".join(" ".join(parts[:n]).split()))) for n in range(1, len(parts) + 1)]
    for licence in dict.fromkeys(licence for licence, _ in TEXTS):
        if licence not in ("All-rights-reserved", "Perl"):
            tag = _plain(f"SPDX-License-Identifier: {licence}")
            end = "(?: only| or later)?" if "GPL" in licence else ""
            found.append((licence, tag, rf"\n{tag}{end}\n".replace(" ", r"[ \n]")))
    return found
