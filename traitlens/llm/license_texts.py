"""Licence templates: titles, usual statements, SPDX tags, standard headers and whole licence texts.

Longer licences (GPL, LGPL, MPL, Apache) are known by title, statement and standard header; their whole
texts can be given as further templates (``license_scan.template_files``).
"""

from __future__ import annotations

# Usual licence statements.
STATEMENTS = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0 Universal Public Domain Dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Titles of licence files.
TITLES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]

# Standard headers.
HEADERS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at"""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:"""),
]

# The notice of the GNU licences, of which only the name and version differ.
GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as
published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."""
GNU_WARRANTY = """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details.
You should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."""
GNU = [("AGPL-3.0", "Affero General Public License", "3"), ("GPL-2.0", "General Public License", "2"),
       ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
       ("LGPL-3.0", "Lesser General Public License", "3")]

# Whole licence texts.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY
OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
WHOLE = [
    ("MIT", f"MIT License\nCopyright (c)\n{_MIT_GRANT}\n{_MIT_REST}"),
    ("MIT", _MIT_GRANT),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("BSD-2-Clause", f"BSD 2-Clause License\nCopyright (c)\n{_BSD_CLAUSES}\n{_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\nCopyright (c)\n{_BSD_CLAUSES}\n{_BSD_THIRD}\n{_BSD_DISCLAIMER}"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
]

#: Licences whose SPDX tag is a template; tags of the GNU licences may end in -only or -or-later.
TAGGED = sorted({name for name, _ in STATEMENTS + TITLES})
TAGS = [(name, f"SPDX-License-Identifier: {name}{end}") for name in TAGGED
        for end in (("", "-only", "-or-later") if "GPL" in name else ("",))]

TEMPLATES = STATEMENTS + TITLES + HEADERS + WHOLE + TAGS + [
    (name, text.format(title, version)) for name, title, version in GNU
    for text in (GNU_NOTICE, GNU_NOTICE + "\n" + GNU_WARRANTY)]
