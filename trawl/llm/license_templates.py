"""License notices and texts in a small template markup.

``[...]`` is a region that may be left out, ``{name:a-b}`` one that is replaced by any ``a`` to ``b``
words. All other words are mandatory. Signs between words and the case of A-Z do not count.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Template:
    """``kind`` is ``phrase`` for a few telling words, ``notice`` for a reference, ``text`` for a license's own wording."""

    name: str
    label: str
    kind: str
    markup: str


def _notices(label: str, *markups: str) -> list[Template]:
    return [Template(f"{label}-notice-{n}", label, "notice", m) for n, m in enumerate(markups, 1)]


#: Versions of the Creative Commons licenses.
_CC = "[1] [2] [3] [4] [0] [5] [International] [Unported]"

# The phrases and their labels.
PHRASES = [
    Template("mit-phrase", "mit", "phrase", "under the MIT License"),
    Template("apache-2-phrase", "apache-2", "phrase", "Apache License, Version 2"),
    Template("cc-by-nc-phrase", "cc-by-nc", "phrase", "CC BY-NC"),
]

NOTICES = [
    *_notices("mit", "released under [the terms of] the MIT [(Expat)] License", "SPDX-License-Identifier: MIT",
              "licensed under [the terms of] [the] MIT [(Expat)] License"),
    *_notices("apache-2", "licensed under [the terms of] the Apache License, Version 2.0",
              "SPDX-License-Identifier: Apache-2.0"),
    *_notices("cc-by-nc", f"licensed under [a] [Creative Commons] CC BY-NC {_CC} [license]",
              f"licensed under a Creative Commons Attribution-NonCommercial {_CC} License"),
    *_notices("cc-by", f"licensed under a Creative Commons Attribution {_CC} License",
              "SPDX-License-Identifier: CC-BY-4.0"),
    *_notices("cc-by-sa", f"licensed under a Creative Commons Attribution-ShareAlike {_CC} License",
              f"licensed under [a] [Creative Commons] CC BY-SA {_CC} [license]"),
    *_notices("gpl-3", "licensed under [the terms of] the GNU General Public License, version 3 "
              "[or [(at your option)] any later version]", "SPDX-License-Identifier: GPL-3.0"),
    *_notices("gpl-2", "licensed under [the terms of] the GNU General Public License, version 2 "
              "[or [(at your option)] any later version]", "SPDX-License-Identifier: GPL-2.0"),
    *_notices("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
              "SPDX-License-Identifier: MPL-2.0"),
    *_notices("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    *_notices("bsd-2-clause", "SPDX-License-Identifier: BSD-2-Clause"),
]

_DISCLAIMED = """THIS SOFTWARE IS PROVIDED [BY] {holder:0-12} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL {owner:1-12} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""

_TWO_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: {number:0-1} Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. {number:0-1} Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""

# The licenses' own wording.
TEXTS = [
    Template("mit-text", "mit", "text", """
Permission is hereby granted, free of charge, to any person obtaining a copy of {work:1-12} (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice
[(including the next paragraph)] shall be included in all copies or substantial portions of the Software.
[THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {holder:1-12} BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE]"""),
    Template("bsd-2-clause-text", "bsd-2-clause", "text", f"{_TWO_CLAUSES} {_DISCLAIMED}"),
    Template("bsd-3-clause-text", "bsd-3-clause", "text", f"""{_TWO_CLAUSES} {{number:0-1}} Neither the name of
{{holder:1-16}} nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission. [{_DISCLAIMED}]"""),
    Template("isc-text", "isc", "text", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    Template("apache-2-text", "apache-2", "text", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at {address:0-12} Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. [See the License for the specific language governing permissions and limitations
under the License.]"""),
    Template("gpl-3-text", "gpl-3", "text", """
is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, [either] version 3 of the License [, or (at your option) any later
version]"""),
    Template("unlicense-text", "unlicense", "text", """
This is free and unencumbered software released into the public domain. [Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.]"""),
]

TEMPLATES = PHRASES + NOTICES + TEXTS
