"""Hand-written signatures of license texts: grants, conditions, disclaimers, headers and addresses.

Each line is a label, a keyword that every match contains, a priority, a
confidence and a regular expression over lower-cased text. A space stands for
any run of white space and comment marks, as texts are wrapped and commented
out. Of signatures with one priority the earlier line wins. The wordings are
those of the licenses themselves.
"""

from __future__ import annotations

#: What a space of a signature stands for.
GAP = r"[\s*#/;%!>|]+"

#: Every match of a signature contains one of these, so texts without any are passed over before keywords are looked for.
GATES = (
    "licen", "software", "copy", "copies", "redistribut", "exception", "domain", "confidential", "reproduc", "heirs", "beer", "usage", "university",
    "sections", "library", "mozilla.org", "affirmer", "universal", "consortium", "eclipse", "creative",
)

#: (label, keyword, priority, confidence, signature)
SIGNATURES = (
    # permissive grants
    ("mit", "restriction", 6, 0.99, r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(?the [\"'“]?software[\"'”]?\)?, to deal in the software without restriction"),
    ("mit", "obtaining", 5, 0.95, r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial", 4, 0.9, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("x11", "consortium", 6, 0.95, r"except as contained in this notice, the name of the x consortium shall not be used in advertising"),
    ("mit-0", "furnished", 6, 0.9, r"permit persons to whom the software is furnished to do so\.? the software is provided [\"'“]?as is"),
    ("isc", "disclaims", 6, 0.97, r"permission to use, copy, modify, and ?/?o?r? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\.? the software is provided [\"'“]?as is[\"'”]? and (?:the author|isc) disclaims"),
    ("isc", "purpose", 5, 0.9, r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"),
    ("0bsd", "purpose", 5, 0.9, r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted\.? the software is provided"),
    ("hpnd", "documentation", 5, 0.9, r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
    ("ntp", "documentation", 5, 0.9, r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("zlib", "altered", 6, 0.97, r"altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("zlib", "origin", 5, 0.95, r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("zlib", "damages", 4, 0.85, r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "executable", 6, 0.97, r"unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor"),
    ("boost", "boost", 5, 0.95, r"boost software license - version 1\.0"),
    ("boost", "accompanying", 5, 0.95, r"distributed under the boost software license, version 1\.0\.? \(?see accompanying file"),
    ("unlicense", "unencumbered", 6, 0.98, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "heirs", 5, 0.9, r"we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("wtfpl", "fuck", 6, 0.97, r"do what the fuck you want to public license"),
    ("beerware", "beer", 6, 0.97, r"if we meet some day, and you think this stuff is worth it, you can buy me a beer"),
    ("fair", "usage", 5, 0.9, r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("curl", "curl", 5, 0.9, r"copyright and permission notice .{0,80}curl"),
    ("postgresql", "agreement", 6, 0.95, r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("ncsa", "university", 5, 0.92, r"university of illinois/ncsa open source license"),
    ("ncsa", "with the software", 4, 0.85, r"permission is hereby granted, free of charge, to any person obtaining a copy of this software .{0,200}deal with the software without restriction"),
    ("upl-1.0", "larger", 5, 0.92, r"a copy of the software, and any (?:person|copy) .{0,120}larger works?"),
    ("afl-3.0", "academic", 5, 0.92, r"academic free license,? \(?[\"'“]?afl[\"'”]?\)? v(?:ersion|\.) ?3\.0"),
    ("artistic-2.0", "artistic", 5, 0.95, r"the artistic license 2\.0"),
    ("artistic-1.0", "artistic", 5, 0.9, r"the [\"'“]?artistic license[\"'”]? preamble"),
    ("artistic-1.0", "copyright holder", 4, 0.85, r"copyright holder maintains some semblance of artistic control over the development of the package"),
    ("python", "psf", 6, 0.95, r"psf license agreement for python"),
    ("python", "licensee", 5, 0.92, r"python software foundation \(?[\"'“]?psf[\"'”]?\)?, and the individual or organization \(?[\"'“]?licensee"),
    ("php-3.01", "php", 5, 0.95, r"the php license, version 3\.01"),
    ("php-3.0", "php", 4, 0.9, r"products derived from this software may not be called [\"'“]?php"),
    ("ruby", "ruby", 4, 0.85, r"you may make and give away verbatim copies of the source form of the software without restriction.{0,400}ruby"),
    ("vim", "vim", 5, 0.92, r"vim license .{0,60}there are no restrictions on distributing unmodified copies of vim"),
    ("openssl", "openssl", 6, 0.95, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "cryptographic", 5, 0.9, r"this product includes cryptographic software written by eric young"),
    ("icu", "unicode", 5, 0.9, r"unicode(?:,? inc\.?)? license agreement - data files and software"),
    ("ofl-1.1", "sil", 6, 0.97, r"sil open font license,? version 1\.1"),
    ("ofl-1.1", "font", 5, 0.95, r"this font software is licensed under the sil open font license"),
    ("ofl-1.1", "reserved font", 4, 0.9, r"no modified version of the font software may use the reserved font name"),
    # bsd conditions
    ("bsd-4-clause", "advertising", 6, 0.97, r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause", "endorse", 6, 0.96, r"neither the names? of .{1,120}? nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause", "endorse", 5, 0.93, r"the names? of .{1,80}? may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "redistributions", 4, 0.9, r"redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "reproduce", 4, 0.9, r"redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("bsd", "redistribution", 4, 0.88, r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "freebsd", 5, 0.92, r"the freebsd (?:copyright|project)\.? .{0,200}redistribution and use in source and binary forms"),
    ("bsd-3-clause-clear", "patent rights", 6, 0.95, r"no express or implied licenses to any party's patent rights are granted by this license"),
    ("bsd", "regents", 4, 0.88, r"the regents of the university of california\.? all rights reserved"),
    # apache
    ("apache-2.0", "apache", 6, 0.99, r"licensed under the apache license, version 2\.0 \(?the [\"'“]?license[\"'”]?\)?; you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache", 5, 0.97, r"apache license,? version 2\.0,? january 2004"),
    ("apache-2.0", "apache", 5, 0.95, r"https?://www\.apache\.org/licenses/license-2\.0"),
    ("apache-2.0", "warranties", 4, 0.88, r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an [\"'“]?as is[\"'”]? basis, without warranties or conditions of any kind"),
    ("apache-2.0", "licensor", 4, 0.85, r"[\"'“]?licensor[\"'”]? shall mean the copyright owner or entity authorized by the copyright owner that is granting the license"),
    ("apache-2.0", "irrevocable", 4, 0.85, r"perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (?:copyright|\(except as stated in this section\) patent) license"),
    ("apache-1.1", "apache", 5, 0.95, r"the apache software license, version 1\.1"),
    ("apache-1.1", "apache", 4, 0.9, r"products derived from this software may not be called [\"'“]?apache"),
    ("apache-1.0", "apache", 5, 0.93, r"this product includes software developed by the apache group for use in the apache http server project"),
    ("llvm-exception", "llvm", 6, 0.95, r"apache license v2\.0 with llvm exceptions?"),
    # the gpl family
    ("gpl-3.0", "version 3", 6, 0.97, r"gnu general public license,? version 3, 29 june 2007"),
    ("gpl-2.0", "june 1991", 6, 0.97, r"gnu general public license,? version 2, june 1991"),
    ("lgpl-3.0", "lesser", 6, 0.97, r"gnu lesser general public license,? version 3, 29 june 2007"),
    ("lgpl-2.1", "february", 6, 0.97, r"gnu lesser general public license,? version 2\.1, february 1999"),
    ("lgpl-2.0", "library", 6, 0.97, r"gnu library general public license,? version 2, june 1991"),
    ("agpl-3.0", "affero", 6, 0.97, r"gnu affero general public license,? version 3, 19 november 2007"),
    ("gfdl", "documentation", 6, 0.95, r"gnu free documentation license,? version 1\.[123]"),
    ("gfdl", "invariant", 5, 0.92, r"with no invariant sections, no front-cover texts,? and no back-cover texts"),
    ("gpl-3.0-or-later", "redistribute", 6, 0.97, r"redistribute it and/?or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or \(?at your option\)? any later version"),
    ("gpl-2.0-or-later", "redistribute", 6, 0.97, r"redistribute it and/?or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license, or \(?at your option\)? any later version"),
    ("lgpl-3.0-or-later", "lesser", 6, 0.97, r"under the terms of the gnu lesser general public license as published by the free software foundation, either version 3 of the license, or \(?at your option\)? any later version"),
    ("lgpl-2.1-or-later", "lesser", 6, 0.97, r"under the terms of the gnu lesser general public license as published by the free software foundation; either version 2\.1 of the license, or \(?at your option\)? any later version"),
    ("lgpl-2.0-or-later", "library", 6, 0.96, r"under the terms of the gnu library general public license as published by the free software foundation; either version 2 of the license"),
    ("agpl-3.0-or-later", "affero", 6, 0.97, r"under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license, or \(?at your option\)? any later version"),
    ("gpl-2.0-only", "modify", 5, 0.93, r"modify it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3.0-only", "modify", 5, 0.93, r"modify it under the terms of the gnu general public license version 3 as published by the free software foundation"),
    ("gpl", "merchantability", 4, 0.85, r"without even the implied warranty of merchantability or fitness for a particular purpose\.? see the gnu general public license"),
    ("lgpl", "merchantability", 4, 0.85, r"without even the implied warranty of merchantability or fitness for a particular purpose\.? see the gnu lesser general public license"),
    ("agpl", "merchantability", 4, 0.85, r"without even the implied warranty of merchantability or fitness for a particular purpose\.? see the gnu affero general public license"),
    ("gpl", "received", 4, 0.85, r"you should have received a copy of the gnu general public license along with this"),
    ("lgpl", "received", 4, 0.85, r"you should have received a copy of the gnu lesser general public license along with this"),
    ("agpl", "received", 4, 0.85, r"you should have received a copy of the gnu affero general public license along with this"),
    ("gpl", "gnu.org", 4, 0.85, r"https?://www\.gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("lgpl", "gnu.org", 4, 0.85, r"https?://www\.gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("agpl", "gnu.org", 4, 0.85, r"https?://www\.gnu\.org/licenses/agpl"),
    ("classpath-exception", "linking", 6, 0.95, r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gcc-exception", "runtime", 6, 0.95, r"gcc runtime library exception,? version 3\.1"),
    ("bison-exception", "bison", 6, 0.93, r"as a special exception, you may create a larger work that contains part or all of the bison parser skeleton"),
    ("autoconf-exception", "autoconf", 6, 0.93, r"as a special exception .{0,160}configuration script generated by autoconf"),
    # other copyleft
    ("mpl-2.0", "mozilla", 6, 0.98, r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-2.0", "mozilla", 5, 0.95, r"https?://mozilla\.org/mpl/2\.0"),
    ("mpl-2.0", "incompatible", 4, 0.88, r"incompatible with secondary licenses"),
    ("mpl-1.1", "mozilla", 6, 0.96, r"subject to the mozilla public license version 1\.1 \(?the [\"'“]?license"),
    ("mpl-1.0", "mozilla", 6, 0.94, r"subject to the mozilla public license version 1\.0"),
    ("epl-2.0", "eclipse", 6, 0.96, r"under the terms of the eclipse public license,? (?:v\.? ?|version )?2\.0"),
    ("epl-1.0", "eclipse", 6, 0.96, r"under the terms of the eclipse public license,? (?:v\.? ?|version )?1\.0"),
    ("epl", "eclipse", 5, 0.9, r"https?://www\.eclipse\.org/legal/epl"),
    ("cddl-1.0", "cddl", 6, 0.95, r"common development and distribution license \(?cddl\)? version 1\.0"),
    ("cddl-1.1", "cddl", 6, 0.95, r"common development and distribution license \(?cddl\)? version 1\.1"),
    ("cddl", "development", 4, 0.9, r"subject to the terms of the common development and distribution license"),
    ("cpl-1.0", "common public", 5, 0.92, r"common public license (?:- )?v(?:ersion)? ?1\.0"),
    ("ipl-1.0", "ibm", 5, 0.92, r"ibm public license version 1\.0"),
    ("eupl-1.2", "eupl", 6, 0.95, r"european union public licence,? v\.? ?1\.2.{0,40}eupl"),
    ("eupl-1.1", "eupl", 6, 0.93, r"european union public licence,? v\.? ?1\.1.{0,40}eupl"),
    ("osl-3.0", "open software", 5, 0.92, r"open software license,? \(?[\"'“]?osl[\"'”]?\)? v(?:ersion|\.) ?3\.0"),
    ("ms-pl", "microsoft", 5, 0.93, r"microsoft public license \(?ms-pl\)?"),
    ("ms-rl", "microsoft", 5, 0.93, r"microsoft reciprocal license \(?ms-rl\)?"),
    ("qpl-1.0", "trolltech", 5, 0.92, r"the q public license,? version 1\.0.{0,80}trolltech"),
    ("sleepycat", "sleepycat", 5, 0.92, r"redistributions in any form must be accompanied by information on how to obtain complete source code.{0,400}sleepycat"),
    ("cecill-2.1", "cecill", 6, 0.94, r"cecill free software license agreement,? version 2\.1"),
    ("cecill", "cecill", 5, 0.9, r"governed by the cecill(?:-[bc])? license under french law"),
    ("odbl", "database", 5, 0.92, r"open (?:data commons )?(?:open )?database license \(?odbl\)?"),
    ("pddl", "dedication", 5, 0.92, r"public domain dedication and licen[sc]e \(?pddl\)?"),
    ("odc-by", "attribution", 5, 0.9, r"open data commons attribution license"),
    # creative commons
    ("cc0", "waives", 6, 0.95, r"affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives"),
    ("cc0", "universal", 6, 0.96, r"cc0 1\.0 universal"),
    ("cc0", "creativecommons", 5, 0.95, r"https?://creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by-nc-nd", "creativecommons", 6, 0.96, r"https?://creativecommons\.org/licenses/by-nc-nd/[1-4]\.0"),
    ("cc-by-nc-sa", "creativecommons", 6, 0.96, r"https?://creativecommons\.org/licenses/by-nc-sa/[1-4]\.0"),
    ("cc-by-nc", "creativecommons", 6, 0.96, r"https?://creativecommons\.org/licenses/by-nc/[1-4]\.0"),
    ("cc-by-nd", "creativecommons", 6, 0.96, r"https?://creativecommons\.org/licenses/by-nd/[1-4]\.0"),
    ("cc-by-sa", "creativecommons", 6, 0.96, r"https?://creativecommons\.org/licenses/by-sa/[1-4]\.0"),
    ("cc-by", "creativecommons", 6, 0.96, r"https?://creativecommons\.org/licenses/by/[1-4]\.0"),
    ("cc-by-nc-nd", "noderivatives", 6, 0.95, r"creative commons attribution(?:-| )noncommercial(?:-| )noderivatives [1-4]\.0"),
    ("cc-by-nc-sa", "sharealike", 6, 0.95, r"creative commons attribution(?:-| )noncommercial(?:-| )sharealike [1-4]\.0"),
    ("cc-by-nc", "noncommercial", 5, 0.94, r"creative commons attribution(?:-| )noncommercial [1-4]\.0"),
    ("cc-by-sa", "sharealike", 5, 0.94, r"creative commons attribution(?:-| )sharealike [1-4]\.0"),
    ("cc-by-nd", "noderivatives", 5, 0.94, r"creative commons attribution(?:-| )noderivatives [1-4]\.0"),
    ("cc-by", "attribution", 4, 0.92, r"creative commons attribution [1-4]\.0"),
    ("cc-by", "credit", 3, 0.8, r"you must give appropriate credit, provide a link to the license, and indicate if changes were made"),
    # not open, and general notices
    ("commons-clause", "commons clause", 6, 0.95, r"[\"'“]?commons clause[\"'”]? license condition v1\.0"),
    ("busl-1.1", "business source", 6, 0.96, r"business source license 1\.1"),
    ("sspl-1.0", "server side", 6, 0.96, r"server side public license,? version 1"),
    ("elastic-2.0", "elastic", 5, 0.93, r"elastic license 2\.0"),
    ("polyform", "polyform", 5, 0.93, r"polyform (?:noncommercial|small business|shield|perimeter|strict) license 1\.0\.0"),
    ("json", "evil", 6, 0.95, r"the software shall be used for good, not evil"),
    ("proprietary", "unauthorized", 3, 0.85, r"unauthorized copying of this file,? via any medium,? is strictly prohibited"),
    ("proprietary", "confidential", 3, 0.8, r"(?:this software|this file|this document) (?:is|contains) (?:the )?(?:proprietary and confidential|confidential and proprietary)(?: information| property)?"),
    ("proprietary", "transmitted", 3, 0.8, r"no part of this (?:publication|book|work|document) may be reproduced,? (?:stored in a retrieval system,? or |distributed,? or )?transmitted in any form or by any means"),
    ("public-domain", "dedicated", 3, 0.85, r"(?:has been |is hereby |is )?dedicated to the public domain"),
    ("public-domain", "placed", 3, 0.85, r"(?:has been |is hereby |is )?placed in(?:to)? the public domain"),
    # identifiers in package metadata and badges
    ("mit", "opensource", 4, 0.9, r"https?://(?:www\.)?opensource\.org/licenses/mit(?:-license)?"),
    ("bsd-3-clause", "opensource", 4, 0.9, r"https?://(?:www\.)?opensource\.org/licenses/bsd-3-clause"),
    ("bsd-2-clause", "opensource", 4, 0.9, r"https?://(?:www\.)?opensource\.org/licenses/bsd-2-clause"),
    ("isc", "opensource", 4, 0.9, r"https?://(?:www\.)?opensource\.org/licenses/isc"),
    ("mit", "osi approved", 4, 0.92, r"license :: osi approved :: mit license"),
    ("apache-2.0", "osi approved", 4, 0.92, r"license :: osi approved :: apache software license"),
    ("bsd", "osi approved", 4, 0.92, r"license :: osi approved :: bsd license"),
    ("gpl-3.0", "osi approved", 4, 0.92, r"license :: osi approved :: gnu general public license v3(?: or later)? \(gplv3\+?\)"),
    ("mpl-2.0", "osi approved", 4, 0.92, r"license :: osi approved :: mozilla public license 2\.0 \(mpl 2\.0\)"),
    ("proprietary", "other/proprietary", 4, 0.9, r"license :: other/proprietary license"),
)
