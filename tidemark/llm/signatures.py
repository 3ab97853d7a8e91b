"""Signatures of licences: what their own texts, notices, exceptions and denials say, in order of priority.

Each is (label, keyword, pattern, confidence), over words with one blank in between, lower-cased, without punctuation.
The keyword stands in every text that the pattern matches. An earlier signature hides a later one that lies within it.
A denial has no label: it only hides what it covers.
"""

from __future__ import annotations

_NEXT = r"(?: (?!but |instead |rather |however |see )[^ ]+){1,8}"

# Phrases as licences and notices word them.
DENIALS = [
    (" not ", rf"(?:is|are|was|were) not (?:licensed|released|distributed|available|published|provided|covered) (?:under|by){_NEXT}"),
    (" not ", rf"not (?:been )?(?:licensed|relicensed|released|distributed|published) under{_NEXT}"),
    (" never ", rf"never (?:been )?(?:licensed|relicensed|released|distributed|published) under{_NEXT}"),
    (" not ", rf"(?:does|do|did) not (?:use|apply|fall under|grant){_NEXT}"),
    (" not ", rf"not compatible with{_NEXT}"),
    (" incompatible ", rf"incompatible with{_NEXT}"),
    (" unlike ", rf"unlike{_NEXT}"),
    (" instead ", rf"instead of{_NEXT}"),
    (" longer ", rf"no longer (?:licensed|released|distributed|available|published) under{_NEXT}"),
    (" rather ", rf"rather than{_NEXT}"),
]

EXCEPTIONS = [
    ("gpl-with-classpath-exception", " classpath ", "gnu general public license version 2 with (?:the )?classpath exception"),
    ("gpl-with-classpath-exception", " classpath ", "gpl (?:v)?2 with (?:the )?classpath exception"),
    ("gpl-with-classpath-exception", " independent modules ", "permission to link this library with independent modules to produce an executable"),
    ("gpl-with-gcc-exception", " gcc runtime ", "gcc runtime library exception(?: version 3 1)?"),
    ("gpl-with-autoconf-exception", " autoconf ", "as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configur(?:e|ation) script generated by autoconf"),
    ("gpl-with-bison-exception", " bison ", "special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-with-font-exception", " font ", "special exception if you create a document which uses this font and embed this font"),
    ("gpl-with-openssl-exception", " openssl ", "permission to link (?:the code of )?(?:this program|portions of this program) with the openssl (?:library|project s openssl library)"),
    ("gpl-with-linux-syscall-note", " linux ", "linux syscall note"),
    ("apache-with-llvm-exception", " llvm ", "apache license (?:v2 0|version 2 0|2 0) with llvm exceptions?"),
    ("gpl-with-universal-foss-exception", " foss exception ", "universal foss exception(?: version 1 0)?"),
    ("qt-gpl-exception", " qt ", "the qt company gpl exception 1 0"),
]

NOTICES = [
    # GNU notices.
    ("gpl-2.0-or-later", " version 2 ", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", " version 3 ", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0", " version 2 ", "under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3.0", " version 3 ", "under the terms of the gnu general public license version 3 as published by the free software foundation"),
    ("lgpl-2.1-or-later", " version 2 1 ", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3.0-or-later", " version 3 ", "gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2.0-or-later", " library general ", "gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("agpl-3.0-or-later", " affero ", "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", " copy of the gnu ", "you should have received a copy of the gnu general public license along with this (?:program|library|software|file)"),
    ("lgpl", " copy of the gnu ", "you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:program|library|software|file)"),
    ("agpl", " copy of the gnu ", "you should have received a copy of the gnu affero general public license along with this (?:program|library|software)"),
    ("gpl-3.0", " version 3 29 ", "gnu general public license version 3 29 june 2007"),
    ("gpl-2.0", " version 2 june ", "gnu general public license version 2 june 1991"),
    ("gpl-1.0", " version 1 february ", "gnu general public license version 1 february 1989"),
    ("lgpl-3.0", " version 3 29 ", "gnu lesser general public license version 3 29 june 2007"),
    ("lgpl-2.1", " february 1999 ", "gnu lesser general public license version 2 1 february 1999"),
    ("agpl-3.0", " november 2007 ", "gnu affero general public license version 3 19 november 2007"),
    ("gpl", " copyleft license ", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", " freedom to share ", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("agpl", " affero ", "remote network interaction use with the gnu affero general public license|gnu affero general public license is a free copyleft license"),
    ("gfdl", " invariant sections ", "free documentation license version 1 [123] or any later version published by the free software foundation with no invariant sections"),
    ("gfdl", " document under ", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    # Apache.
    ("apache-2.0", " apache ", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", " january 2004 ", "apache license version 2 0 january 2004"),
    ("apache-2.0", " apache org licenses ", "(?:http|https) www apache org licenses license 2 0"),
    ("apache-2.0", " apache software foundation ", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", " agreed to in writing ", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", " patent license ", "grant of patent license subject to the terms and conditions of this license each contributor hereby grants to you a perpetual"),
    ("apache-1.1", " apache software license ", "the apache software license version 1 1"),
    ("apache-1.0", " apache group ", "this product includes software developed by the apache group for use in the apache http server project"),
    ("apache-1.1", " apache software foundation ", "this product includes software developed by the apache software foundation"),
    # MIT and its kin.
    ("mit", " hereby granted ", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", " above copyright notice ", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", " mit no attribution ", "mit no attribution(?: license)?"),
    ("x11", " x consortium ", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("mit-modern-variant", " hereby granted ", "permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute this software"),
    ("hpnd", " without fee ", "permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose is hereby granted without fee"),
    ("isc", " for any purpose ", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", " for any purpose ", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", " zero clause ", "zero clause bsd(?: license)?"),
    ("mit-advertising", " advertising ", "advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment mit"),
    ("curl", " curl ", "curl license|licensed under the curl license"),
    ("ncsa", " illinois ", "university of illinois ncsa open source license"),
    ("icu", " icu ", "icu license icu 1 8 1 and later"),
    ("unicode-dfs", " unicode ", "unicode inc license agreement data files and software"),
    ("postgresql", " postgresql ", "postgresql license|the postgresql licence"),
    ("bzip2", " bzip2 ", "bzip2 license|bzip2 and libbzip2 license"),
    ("libpng", " libpng ", "libpng license(?: version 2)?"),
    ("zlib", " altered source ", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", " origin of this software ", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", " warranty in no event ", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    # BSD clauses.
    ("bsd", " binary forms ", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", " retain the above ", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", " reproduce the above ", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", " neither the name ", "neither the name of the (?:copyright holder|university|author|organization|foundation) nor the names of (?:its|any|his) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", " advertising materials ", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment this product includes software developed by"),
    ("bsd-4-clause-uc", " california ", "this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd-3-clause-clear", " patent rights ", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-2-clause-patent", " bsd 2 clause plus ", "bsd 2 clause plus patent license"),
    ("bsd-3-clause-lbnl", " lawrence berkeley ", "lawrence berkeley national laboratory bsd variant license|lawrence berkeley national labs bsd variant license"),
    ("bsd-1-clause", " bsd 1 clause ", "bsd 1 clause license"),
    ("bsd-source-code", " bsd source code ", "bsd source code attribution(?: license)?"),
    ("openssl", " openssl ", "this product includes software developed by the openssl project for use in the openssl toolkit|openssl license"),
    ("ssleay", " eric young ", "this product includes cryptographic software written by eric young|redistribution of original ssleay code by eric young"),
    # Weak copyleft.
    ("mpl-2.0", " mozilla ", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", " mozilla org ", "one at (?:http|https) mozilla org mpl 2 0|license at (?:http|https) mozilla org mpl 2 0"),
    ("mpl-1.1", " mozilla ", "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license"),
    ("mpl-2.0-no-copyleft-exception", " secondary licenses ", "this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0"),
    ("epl-2.0", " eclipse ", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0"),
    ("epl-1.0", " eclipse ", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?1 0"),
    ("edl-1.0", " eclipse distribution ", "eclipse distribution license(?: v)?(?: 1 0)?"),
    ("cddl-1.0", " cddl ", "common development and distribution license cddl version 1 0"),
    ("cddl-1.1", " cddl ", "common development and distribution license cddl version 1 1"),
    ("cpl-1.0", " common public ", "under the terms of the common public license v1 0 which accompanies this distribution"),
    ("ibm-pl-1.0", " ibm ", "ibm public license version 1 0|ibm public license"),
    ("eupl-1.2", " eupl ", "licensed under the eupl version 1 2(?: or later)?|licensed under the eupl 1 2(?: or later)?"),
    ("eupl-1.1", " eupl ", "licensed under the eupl version 1 1(?: only)?|licensed under the eupl 1 1"),
    ("ms-pl", " microsoft ", "microsoft public license(?: ms pl)?"),
    ("ms-rl", " microsoft ", "microsoft reciprocal license(?: ms rl)?"),
    ("apsl-2.0", " apple ", "apple public source license version 2 0|apple public source license"),
    ("npl-1.1", " netscape ", "netscape public license version 1 1|netscape public license"),
    ("qpl-1.0", " q public ", "the q public license version 1 0|q public license"),
    ("rpl-1.5", " reciprocal public ", "reciprocal public license(?: version)?(?: 1 5)?"),
    ("cpal-1.0", " attribution license ", "common public attribution license(?: version 1 0)?"),
    ("cecill-2.1", " cecill ", "cecill free software license agreement|licence cecill|cecill license"),
    ("sleepycat", " sleepycat ", "sleepycat license|the sleepycat software license"),
    ("vim", " vim ", "vim license|the vim licence"),
    ("ruby", " ruby ", "ruby license|same terms as ruby license"),
    ("artistic-1.0-perl", " perl ", "under the same terms as perl itself license|same license as perl itself"),
    ("artistic-2.0", " perl foundation ", "the artistic license 2 0 copyright c 2000 2006 the perl foundation"),
    ("php-3.01", " php ", "the php license version 3 01|php license version 3 01"),
    ("php-3.0", " php ", "the php license version 3 0|php license version 3 0"),
    ("w3c", " w3c ", "w3c software notice and license|w3c software and document notice and license|w3c software license"),
    ("intel", " intel ", "intel open source license|intel simplified software license"),
    ("upl-1.0", " universal permissive ", "universal permissive license(?: upl)?(?: version)?(?: 1 0)?"),
    ("mulan-psl-2.0", " mulan ", "mulan permissive software license(?: version 2)?|mulan psl v2 licensed"),
    ("bsl-1.0", " boost ", "distributed under the boost software license version 1 0"),
    ("bsl-1.0", " covered by this license ", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("beerware", " beer ", "beer ware license|the beer ware license revision 42"),
    ("jquery", " jquery ", "released under the mit license (?:http|https) jquery org license"),
    ("json", " good not evil ", "the software shall be used for good not evil (?:json )?license"),
    # Fonts, data and creative works.
    ("ofl-1.1", " sil ", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl", " reserved font name ", "with reserved font name"),
    ("ubuntu-font-1.0", " ubuntu font ", "ubuntu font licen[cs]e version 1 0|ubuntu font licen[cs]e"),
    ("bitstream-vera", " bitstream ", "bitstream vera fonts copyright license|bitstream vera license"),
    ("odbl-1.0", " open database ", "made available under the open database license"),
    ("odc-by-1.0", " open data commons ", "open data commons attribution license(?: v1 0)?"),
    ("pddl-1.0", " public domain dedication ", "open data commons public domain dedication and licen[cs]e"),
    ("cdla-permissive-2.0", " community data ", "community data license agreement permissive(?: version)?(?: 2 0)?"),
    ("cdla-sharing-1.0", " community data ", "community data license agreement sharing(?: version)?(?: 1 0)?"),
    ("ogl-uk-3.0", " open government ", "contains public sector information licensed under the open government licence v3 0|open government licence v3 0"),
    ("ogl", " open government ", "open government licen[cs]e"),
    ("etalab-2.0", " licence ouverte ", "licence ouverte(?: open licence)?(?: version)?(?: 2 0)?"),
    ("dl-de-by-2.0", " datenlizenz ", "datenlizenz deutschland namensnennung(?: version)? 2 0"),
    ("cc0-1.0", " waived ", "has waived all copyright and related (?:or|and) neighboring rights to this work(?: under cc0)?"),
    ("cc0-1.0", " cc0 ", "cc0 1 0 universal cc0 1 0 public domain dedication"),
    ("cc-pdm-1.0", " public domain mark ", "public domain mark 1 0"),
    ("cc-by-4.0", " creative commons ", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", " creative commons ", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-4.0", " creative commons ", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc-sa-4.0", " creative commons ", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nd-4.0", " creative commons ", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-nd-4.0", " creative commons ", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("cc-by-sa-3.0", " creative commons ", "text is available under the creative commons attribution share ?alike license"),
    ("cc-by-4.0", " creativecommons org ", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-4.0", " creativecommons org ", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", " creativecommons org ", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", " creativecommons org ", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", " creativecommons org ", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", " creativecommons org ", "creativecommons org licenses by nc nd 4 0"),
    ("cc0-1.0", " creativecommons org ", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", " namensnennung ", "creative commons namensnennung(?: 4 0)?(?: international)?(?: lizenz)?"),
    ("cc-by", " paternité ", "creative commons paternité|licence creative commons paternité"),
    ("cc-by", " reconocimiento ", "creative commons reconocimiento(?: 4 0)?(?: internacional)?"),
    ("fal-1.3", " free art ", "free art license(?: 1 3)?"),
    # Dedications.
    ("unlicense", " unencumbered ", "this is free and unencumbered software released into the public domain"),
    ("public-domain", " to the public domain ", "the author(?:s)? (?:hereby )?dedicate(?:s)? (?:this work|any and all copyright interest in the software) to the public domain"),
    ("public-domain", " public domain ", "(?:this (?:work|file|code|software) is|hereby) in the public domain"),
    ("public-domain", " public domain ", "no copyright is claimed and this (?:work|software|file) is in the public domain"),
    ("us-government-work", " public domain ", "work of the (?:u s|united states) government and (?:is )?in the public domain"),
    ("wtfpl", " do what the ", "do what the fuck you want to public license(?: version 2)?"),
    # Model and source-available licences.
    ("openrail", " openrail ", "(?:creativeml |bigscience )?openrail(?: m| d| s)? licen[sc]e"),
    ("busl-1.1", " business source ", "business source license(?: 1 1)?"),
    ("sspl-1.0", " server side ", "server side public license(?: version 1| v1)?"),
    ("elastic-2.0", " elastic ", "elastic license(?: 2 0)?"),
    ("confluent", " confluent ", "confluent community license(?: agreement)?(?: version 1 0)?"),
    ("commons-clause", " commons clause ", "commons clause license condition v1 0|commons clause"),
    ("polyform", " polyform ", "polyform (?:noncommercial|small business|shield|strict|perimeter) license(?: 1 0 0)?"),
    ("prosperity-3.0", " prosperity ", "prosperity public license(?: 3 0 0)?"),
    ("parity-7.0", " parity ", "parity public license(?: 7 0 0)?"),
    # Reserved rights.
    ("proprietary", " written permission ", "no part of this (?:publication|book|work|document) may be reproduced (?:distributed |stored )?(?:or transmitted )?in any form or by any means without the prior written permission"),
    ("proprietary", " confidential ", "(?:confidential and proprietary|proprietary and confidential) (?:licensed material|all rights reserved)"),
    ("proprietary", " redistribution ", "unauthorized (?:copying|use) (?:or|and) redistribution (?:of this file )?(?:via any medium )?is strictly prohibited"),
    ("proprietary", " derechos ", "todos los derechos reservados(?: all rights reserved)?"),
    ("proprietary", " rechte ", "alle rechte vorbehalten(?: all rights reserved)?"),
    ("proprietary", " droits ", "tous droits réservés(?: all rights reserved)?"),
    ("proprietary", " reserved ", "copyright all rights reserved|all rights are reserved"),
    ("proprietary", " end user ", "end user licen[sc]e agreement"),
    ("non-commercial", " non commercial ", "(?:licensed|provided|available) for non commercial (?:use|purposes|research) only"),
    ("non-commercial", " personal ", "(?:licensed|free) for personal (?:use|non commercial use) only(?: license)?"),
    ("academic", " academic ", "(?:licensed|available) for academic (?:use|research) only(?: license)?"),
    ("dual", " dual licensed ", "dual licensed under (?:the )?(?:mit and gpl|gpl and mit|mit and apache 2 0|apache 2 0 and mit) licenses?"),
]
# What such a text must hold besides the words of names, for the first look at it.
WORDS = ("vorbehalten", "commercial", "written by", "no attribution", "for personal", "for academic", "réserv", "datenlizenz", "elastic", "unlike", "instead of", "rather than", "compatible", "prohibited", "origin", "altered", "waived",
         "redistribut", "source code form", "developed by", "neither the", "advertising", "materials", "unencumbered", "syscall", "exception", "derechos", "font", "as is", "copyright")


def signatures() -> list[tuple[int, str, str, str, float]]:
    """(place in the order of kinds, label, keyword, pattern, confidence): denials, exceptions, then notices."""
    found = [(-3, "", keyword, pattern, 0.0) for keyword, pattern in DENIALS]
    found += [(-2, label, keyword, pattern, 0.97) for label, keyword, pattern in EXCEPTIONS]
    return found + [(-1, label, keyword, pattern, 0.96) for label, keyword, pattern in NOTICES]
