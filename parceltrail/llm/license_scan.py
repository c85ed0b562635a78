"""Operator 10: license scans by ordered signature rules.

Rules are hand-written patterns: signatures of license texts, notices, identifiers and addresses, statements that name no
license, and a table of license names in a few sentence frames; some hundreds of regular expressions. Each has keywords that
every match holds, and only rules whose keywords a text holds run on it. Detections are resolved in order of priority, then
length, then place: one whose interval lies inside an accepted detection's is suppressed. Exact phrases (`PHRASES`) have the
highest priority and always stay.

Everything is matched on text with A-Z lowered. Words are runs of digits, a-z and signs beyond ASCII; between the words of a
pattern stand one or more other signs, however many (line breaks, comment marks, indentation). Null counts as empty: no words,
no labels, score 0. Rows are scanned one by one (no shuffle), so ties, repeated rows, empty tables and extra columns need no
rule.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm.common import byte_view, documents

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, keyword that every match holds, name as a pattern. A space stands for signs between words, ~ also for none, and
#: {v} for what may stand between a name and its version.
FAMILIES = [
    ("mit", "mit", "mit"),
    ("mit", "expat", "expat"),
    ("x11", "x11", "x11"),
    ("isc", "isc", "isc"),
    ("isc", "internet", "internet systems consortium"),
    ("apache-1", "apache", "apache(?: software)?(?: licen[cs]e)?{v}1(?: [01])?"),
    ("apache-2", "apache", "apache(?: software)?(?: licen[cs]e)?{v}2(?: 0)?"),
    ("apache", "apache", "apache(?: software)?"),
    ("bsd-0-clause", "bsd", "(?:0|zero) clause bsd|bsd (?:0|zero) clause"),
    ("bsd-2-clause", "bsd", "(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd"),
    ("bsd-3-clause", "bsd", "(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd"),
    ("bsd-4-clause", "bsd", "(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd"),
    ("bsd", "bsd", "bsd"),
    ("gpl-1", "gpl", "(?:gnu )?gpl{v}1(?: 0)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl{v}2(?: 0)?"),
    ("gpl-3", "gpl", "(?:gnu )?gpl{v}3(?: 0)?"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gpl-1", "general", "(?:gnu )?general public(?: licen[cs]e)?{v}1(?: 0)?"),
    ("gpl-2", "general", "(?:gnu )?general public(?: licen[cs]e)?{v}2(?: 0)?"),
    ("gpl-3", "general", "(?:gnu )?general public(?: licen[cs]e)?{v}3(?: 0)?"),
    ("gpl", "general", "(?:gnu )?general public"),
    ("lgpl-2", "lgpl", "(?:gnu )?lgpl{v}2(?: 0)?"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl{v}2 1"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl{v}3(?: 0)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("lgpl-2", "library", "(?:gnu )?library general public(?: licen[cs]e)?{v}2(?: 0)?"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public(?: licen[cs]e)?{v}2 1"),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public(?: licen[cs]e)?{v}3(?: 0)?"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public"),
    ("agpl-3", "agpl", "(?:gnu )?agpl{v}3(?: 0)?"),
    ("agpl", "agpl", "(?:gnu )?agpl"),
    ("agpl-3", "affero", "(?:gnu )?affero(?: general public)?(?: licen[cs]e)?{v}3(?: 0)?"),
    ("agpl", "affero", "(?:gnu )?affero(?: general public)?"),
    ("mpl-1.1", "mozilla", "mozilla public(?: licen[cs]e)?{v}1 1"),
    ("mpl-2", "mozilla", "mozilla public(?: licen[cs]e)?{v}2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public"),
    ("mpl-1.1", "mpl", "mpl{v}1 1"),
    ("mpl-2", "mpl", "mpl{v}2(?: 0)?"),
    ("mpl", "mpl", "mpl"),
    ("epl-1", "eclipse", "eclipse public(?: licen[cs]e)?{v}1(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public(?: licen[cs]e)?{v}2(?: 0)?"),
    ("epl", "eclipse", "eclipse public"),
    ("epl-1", "epl", "epl{v}1(?: 0)?"),
    ("epl-2", "epl", "epl{v}2(?: 0)?"),
    ("cddl-1", "cddl", "cddl(?:{v}1(?: [01])?)?"),
    ("cddl-1", "common", "common development and distribution"),
    ("cpl-1", "common", "common public"),
    ("eupl", "eupl", "eupl(?:{v}1 [012])?"),
    ("eupl", "european", "european union public"),
    ("artistic-2", "artistic", "artistic(?: licen[cs]e)?{v}2(?: 0)?"),
    ("artistic", "artistic", "(?:perl )?artistic"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("bsl-1", "boost", "boost(?: software)?(?: 1 0)?"),
    ("psf", "python", "python software foundation"),
    ("psf", "psf", "psf"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ofl-1.1", "font", "(?:sil )?open font(?:{v}1 1)?"),
    ("odbl", "odbl", "odbl(?: 1 0)?"),
    ("odbl", "database", "open database"),
    ("cc0", "cc0", "cc0(?: 1 0)?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", "cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "commons", "creative commons attribution non~commercial no~deriv(?:ative)?s(?: works)?"),
    ("cc-by-nc-sa", "commons", "creative commons attribution non~commercial share~alike"),
    ("cc-by-nc", "commons", "creative commons attribution non~commercial"),
    ("cc-by-nd", "commons", "creative commons attribution no~deriv(?:ative)?s(?: works)?"),
    ("cc-by-sa", "commons", "creative commons attribution share~alike"),
    ("cc-by", "commons", "creative commons attribution"),
    ("cc0", "commons", "creative commons zero"),
    ("cc", "commons", "creative commons"),
    ("elastic-2", "elastic", "elastic(?: licen[cs]e)?{v}2(?: 0)?"),
    ("elastic", "elastic", "elastic"),
    ("sspl-1", "server", "server side public"),
    ("busl", "business", "business source"),
]

#: priority, confidence, word that every match holds, pattern around a name.
FRAMES = [
    (60, 0.99, "spdx", "spdx licen[cs]e identifier {name}"),
    (50, 0.95, "under", "licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{name}(?: (?:public )?licen[cs]e)?"),
    (45, 0.9, "under", "(?:released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{name}(?: (?:public )?licen[cs]e)?"),
    (40, 0.8, "licen", "{name} (?:public )?licen[cs]e"),
    (35, 0.7, "licen", "licen[cs]e (?:is )?(?:the )?{name}"),
]

#: priority and confidence of signatures by kind.
KINDS = {"address": (75, 0.97), "text": (70, 0.95), "notice": (65, 0.9), "id": (33, 0.85), "statement": (30, 0.65), "hint": (10, 0.3)}

#: kind, label, pattern. The three longest plain words of a pattern outside brackets are its keywords.
SIGNATURES = [
    # Texts of licenses.
    ("text", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("text", "mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("text", "mit", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("text", "x11", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("text", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("text", "bsd-0-clause", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("text", "isc", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("text", "bsd", "redistributions of source code must retain the (?:above )?copyright notice"),
    ("text", "bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("text", "bsd-3-clause", "nor the names of (?:its|their|the) contributors may be used to endorse or promote products"),
    ("text", "bsd-3-clause", "may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("text", "bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("text", "apache-2", "terms and conditions for use reproduction and distribution"),
    ("text", "apache-2", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("text", "apache-2", "you must give any other recipients of the work or derivative works a copy of this license"),
    ("text", "apache-1.1", "products derived from this software may not be called apache nor may apache appear in their name"),
    ("text", "apache-1.1", "this product includes software developed by the apache software foundation"),
    ("text", "gpl-2", "gnu general public license version 2 june 1991"),
    ("text", "gpl-3", "gnu general public license version 3 29 june 2007"),
    ("text", "lgpl-2", "gnu library general public license version 2 june 1991"),
    ("text", "lgpl-2.1", "gnu lesser general public license version 2 1 february 1999"),
    ("text", "lgpl-3", "gnu lesser general public license version 3 29 june 2007"),
    ("text", "agpl-3", "gnu affero general public license version 3 19 november 2007"),
    ("text", "gpl", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("text", "gpl", "the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change"),
    ("text", "gpl-2", "the act of running the program is not restricted"),
    ("text", "gpl-3", "protecting users legal rights from anti circumvention law"),
    ("text", "agpl-3", "remote network interaction use with the gnu general public license"),
    ("text", "mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("text", "mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("text", "mpl-2", "covered software is provided under this license on an as is basis"),
    ("text", "epl-1", "the accompanying program is provided under the terms of this eclipse public license"),
    ("text", "epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("text", "epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("text", "cpl-1", "the accompanying program is provided under the terms of this common public license"),
    ("text", "cddl-1", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("text", "eupl", "licensed under the eupl version 1 [012]"),
    ("text", "artistic", "the intent of this document is to state the conditions under which a package may be copied"),
    ("text", "artistic-2", "this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("text", "unlicense", "this is free and unencumbered software released into the public domain"),
    ("text", "unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("text", "wtfpl", "do what the fuck you want to public license"),
    ("text", "wtfpl", "you just do what the fuck you want to"),
    ("text", "zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("text", "zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("text", "bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("text", "bsl-1", "distributed under the boost software license version 1 0"),
    ("text", "psf", "psf is making python available to licensee on an as is basis"),
    ("text", "psf", "subject to the terms and conditions of this license agreement psf hereby grants licensee"),
    ("text", "postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("text", "openssl", "this product includes software developed by the openssl project"),
    ("text", "openssl", "products derived from this software may not be called openssl"),
    ("text", "ofl-1.1", "the fonts and derivatives however cannot be released under any other type of license"),
    ("text", "ofl-1.1", "this font software is licensed under the sil open font license"),
    ("text", "odbl", "this database is made available under the open database license"),
    ("text", "cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("text", "cc0", "has waived all copyright and related or neighboring rights"),
    ("text", "cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("text", "cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license"),
    ("text", "cc-by-nc", "you may not use the material for commercial purposes"),
    ("text", "cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("text", "elastic-2", "you may not provide the software to third parties as a hosted or managed service"),
    ("text", "sspl-1", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("text", "busl", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
    ("text", "gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("text", "ncsa", "university of illinois ncsa open source license"),
    ("text", "json", "the software shall be used for good not evil"),
    ("text", "beerware", "you can buy me a beer in return"),
    ("text", "curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("text", "ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("text", "fair", "usage of the works is permitted provided that this instrument is retained with the works"),
    ("text", "upl-1", "to any person obtaining a copy of this software associated documentation and or data"),
    ("text", "afl-3", "licensed under the academic free license version 3 0"),
    ("text", "osl-3", "licensed under the open software license version 3 0"),
    ("text", "vim", "vim is charityware"),
    ("text", "ruby", "you may make and give away verbatim copies of the source form of the software without restriction"),
    ("text", "php-3", "this product includes php software freely available"),
    # Notices of files and programs.
    ("notice", "apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("notice", "apache-2", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("notice", "apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("notice", "gpl", "this (?:program|file|package|module|script) is free software"),
    ("notice", "lgpl", "this library is free software"),
    ("notice", "gpl-2", "(?:gnu )?general public licen[cs]e as published by the free software foundation (?:either )?version 2"),
    ("notice", "gpl-3", "(?:gnu )?general public licen[cs]e as published by the free software foundation (?:either )?version 3"),
    ("notice", "lgpl-2", "(?:gnu )?library general public licen[cs]e as published by the free software foundation (?:either )?version 2"),
    ("notice", "lgpl-2.1", "(?:gnu )?lesser general public licen[cs]e as published by the free software foundation (?:either )?version 2 1"),
    ("notice", "lgpl-3", "(?:gnu )?lesser general public licen[cs]e as published by the free software foundation (?:either )?version 3"),
    ("notice", "agpl-3", "(?:gnu )?affero general public licen[cs]e as published by the free software foundation (?:either )?version 3"),
    ("notice", "gpl", "you should have received a copy of the gnu general public license"),
    ("notice", "lgpl", "you should have received a copy of the gnu lesser general public license"),
    ("notice", "agpl", "you should have received a copy of the gnu affero general public license"),
    ("notice", "bsd", "use of this source code is governed by a bsd style license"),
    ("notice", "mit", "use of this source code is governed by an mit style license"),
    ("notice", "mit", "mit licensed"),
    ("notice", "bsd", "bsd licensed"),
    ("notice", "apache", "apache licensed"),
    ("notice", "gpl", "gpl licensed"),
    ("notice", "mit", "the mit license mit"),
    ("notice", "mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("notice", "epl", "under the terms of the eclipse public license(?:{v}[12] 0)? which accompanies this distribution"),
    ("notice", "perl", "(?:under the same terms|it and or modify it under the same terms) as perl itself"),
    ("notice", "ruby", "under the same terms as ruby"),
    ("notice", "cc-by-sa", "text is available under the creative commons attribution share~alike license"),
    # Addresses.
    ("address", "apache-2", "apache org licen[cs]es license 2 0"),
    ("address", "apache-1.1", "apache org licen[cs]es license 1 1"),
    ("address", "apache", "apache org licen[cs]es"),
    ("address", "mit", "opensource org licen[cs]es? mit"),
    ("address", "isc", "opensource org licen[cs]es? isc"),
    ("address", "bsd-2-clause", "opensource org licen[cs]es? bsd 2 clause"),
    ("address", "bsd-3-clause", "opensource org licen[cs]es? bsd 3 clause"),
    ("address", "gpl-2", "opensource org licen[cs]es? gpl 2 0"),
    ("address", "gpl-3", "opensource org licen[cs]es? gpl 3 0"),
    ("address", "apache-2", "opensource org licen[cs]es? apache 2 0"),
    ("address", "zlib", "opensource org licen[cs]es? zlib"),
    ("address", "gpl-2", "gnu org licen[cs]es (?:old licenses )?gpl 2 0"),
    ("address", "gpl-3", "gnu org licen[cs]es gpl 3 0"),
    ("address", "gpl", "gnu org licen[cs]es gpl"),
    ("address", "lgpl-2.1", "gnu org licen[cs]es (?:old licenses )?lgpl 2 1"),
    ("address", "lgpl-3", "gnu org licen[cs]es lgpl 3 0"),
    ("address", "lgpl", "gnu org licen[cs]es lgpl"),
    ("address", "agpl-3", "gnu org licen[cs]es agpl 3 0"),
    ("address", "agpl", "gnu org licen[cs]es agpl"),
    ("address", "gfdl", "gnu org licen[cs]es fdl"),
    ("address", "gpl", "gnu org copyleft gpl"),
    ("address", "lgpl", "gnu org copyleft lesser"),
    ("address", "gpl", "gnu org licen[cs]es(?! (?:a|l)?gpl| fdl| old)"),
    ("address", "mpl-2", "mozilla org mpl 2 0"),
    ("address", "mpl-1.1", "mozilla org mpl mpl 1 1"),
    ("address", "mpl", "mozilla org mpl"),
    ("address", "epl-1", "eclipse org legal epl v10"),
    ("address", "epl-2", "eclipse org legal epl 2 0"),
    ("address", "bsl-1", "boost org license 1 0"),
    ("address", "unlicense", "unlicense org"),
    ("address", "wtfpl", "wtfpl net"),
    ("address", "ofl-1.1", "scripts sil org ofl"),
    ("address", "odbl", "opendatacommons org licen[cs]es odbl"),
    ("address", "eupl", "joinup ec europa eu (?:community |software |page |collection )*+eupl"),
    ("address", "artistic-2", "perlfoundation org artistic license 2 0"),
    ("address", "elastic-2", "elastic co licensing elastic license"),
    ("address", "sspl-1", "mongodb com licensing server side public license"),
    ("address", "cc0", "creativecommons org publicdomain zero"),
    ("address", "public-domain", "creativecommons org publicdomain mark"),
    ("address", "cc-by-nc-nd", "creativecommons org licen[cs]es by nc nd"),
    ("address", "cc-by-nc-sa", "creativecommons org licen[cs]es by nc sa"),
    ("address", "cc-by-nc", "creativecommons org licen[cs]es by nc"),
    ("address", "cc-by-nd", "creativecommons org licen[cs]es by nd"),
    ("address", "cc-by-sa", "creativecommons org licen[cs]es by sa"),
    ("address", "cc-by", "creativecommons org licen[cs]es by"),
    ("address", "php-3", "php net license 3"),
    ("address", "zlib", "zlib net zlib license"),
    ("address", "psf", "docs python org (?:[23] )?license"),
    ("address", "curl", "curl (?:haxx )?se docs copyright"),
    # Identifiers that stand alone.
    ("id", "gpl-1", "gpl{v}1 0(?: only| or later)?"),
    ("id", "gpl-2", "gpl{v}2 0(?: only| or later)?"),
    ("id", "gpl-3", "gpl{v}3 0(?: only| or later)?"),
    ("id", "gpl-2", "gpl~v~2"),
    ("id", "gpl-3", "gpl~v~3"),
    ("id", "gpl-2", "gpl (?:version |ver )2"),
    ("id", "gpl-3", "gpl (?:version |ver )3"),
    ("id", "lgpl-2", "lgpl{v}2 0(?: only| or later)?"),
    ("id", "lgpl-2.1", "lgpl{v}2 1(?: only| or later)?"),
    ("id", "lgpl-3", "lgpl{v}3 0(?: only| or later)?"),
    ("id", "lgpl-3", "lgpl~v~3"),
    ("id", "agpl-3", "agpl{v}3 0(?: only| or later)?"),
    ("id", "agpl-3", "agpl~v~3"),
    ("id", "apache-1.1", "apache 1 1"),
    ("id", "apache-2", "apache 2 0"),
    ("id", "apache-2", "asl{v}2(?: 0)?"),
    ("id", "bsd-0-clause", "0bsd"),
    ("id", "bsd-2-clause", "bsd 2 clause(?: patent| views)?"),
    ("id", "bsd-3-clause", "bsd 3 clause(?: clear| lbnl)?"),
    ("id", "bsd-4-clause", "bsd 4 clause(?: uc)?"),
    ("id", "mit-0", "mit 0"),
    ("id", "mpl-1.1", "mpl 1 1"),
    ("id", "mpl-2", "mpl 2 0(?: no copyleft exception)?"),
    ("id", "epl-1", "epl 1 0"),
    ("id", "epl-2", "epl 2 0"),
    ("id", "cddl-1", "cddl 1 [01]"),
    ("id", "cpl-1", "cpl 1 0"),
    ("id", "eupl", "eupl 1 [012]"),
    ("id", "afl-3", "afl 3 0"),
    ("id", "osl-3", "osl 3 0"),
    ("id", "artistic-2", "artistic 2 0"),
    ("id", "bsl-1", "bsl 1 0"),
    ("id", "busl", "busl 1 1"),
    ("id", "cc0", "cc0 1 0"),
    ("id", "cc-by-nc-nd", "cc by nc nd [1-4] [05]"),
    ("id", "cc-by-nc-sa", "cc by nc sa [1-4] [05]"),
    ("id", "cc-by-nd", "cc by nd [1-4] [05]"),
    ("id", "cc-by-sa", "cc by sa [1-4] [05]"),
    ("id", "cc-by", "cc by [1-4] [05]"),
    ("id", "elastic-2", "elastic 2 0"),
    ("id", "sspl-1", "sspl 1 0"),
    ("id", "gfdl", "gfdl 1 [123](?: only| or later)?"),
    ("id", "ofl-1.1", "ofl 1 1"),
    ("id", "odbl", "odbl 1 0"),
    ("id", "ncsa", "uiuc ncsa"),
    ("id", "unicode", "unicode dfs 201[56]"),
    ("id", "upl-1", "upl 1 0"),
    ("id", "zpl-2", "zpl 2 [01]"),
    # Statements that name no license.
    ("statement", "proprietary", "all rights reserved"),
    ("statement", "proprietary", "proprietary and confidential"),
    ("statement", "proprietary", "unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("statement", "proprietary", "may not be reproduced in any form without (?:the )?(?:prior )?(?:written )?permission"),
    ("statement", "public-domain", "(?:in|into|to|released to) the public domain"),
    ("statement", "public-domain", "no rights reserved"),
    ("statement", "permissive", "permission is hereby granted free of charge"),
    ("statement", "permissive", "free for (?:any|personal and commercial|commercial and personal) use"),
    ("statement", "non-commercial", "(?:for )?non~commercial use only"),
    ("statement", "redistribution", "redistribution and use in source and binary forms"),
    ("statement", "source-available", "source available licen[cs]e"),
    ("statement", "dual", "(?:dual|multi) licensed"),
    ("statement", "evaluation", "for evaluation purposes only"),
    ("hint", "no-warranty", "without (?:any )?warranty of any kind"),
    ("hint", "no-warranty", "without any warranty"),
    ("hint", "license-file", "see (?:the )?(?:accompanying )?licen[cs]e file"),
    ("hint", "license-file", "licen[cs]e see (?:the )?copying"),
]

WORD, GAP = "[0-9a-z\\x80-\\xff]", "[^0-9a-z\\x80-\\xff]"
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    priority: int
    confidence: float
    pattern: re.Pattern[bytes]


def compiled(pattern: str) -> re.Pattern[bytes]:
    """Whole words; a space stands for one or more signs between words, ~ for any number of them."""
    spaced = pattern.replace("{v}", "~(?:version~|ver~|v~)?").replace("~", f"{GAP}*+").replace(" ", f"{GAP}++")
    return re.compile(f"(?<!{WORD})(?:{spaced})(?!{WORD})".encode("latin-1"), re.DOTALL)


def keywords_of(pattern: str) -> tuple[bytes, ...]:
    """The three longest plain words outside brackets, which every match of a pattern without alternatives there holds."""
    depth, plain = 0, ""
    pattern = pattern.replace("{v}", "~")
    for at, sign in enumerate(pattern):
        depth += (sign in "([") - (sign in ")]")
        assert sign != "|" or depth, f"{pattern}: alternatives without a word in common"
        bare = depth == 0 and sign.isalnum() and pattern[at + 1 : at + 2] not in ("?", "*")
        plain += sign if bare else " "
    words = sorted(set(plain.split()), key=lambda word: (-len(word), word))
    return tuple(word.encode() for word in words[:3])


@functools.lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules: names in frames, then signatures."""
    named = [
        Rule(label, (keyword.encode(), word.encode()), priority, confidence, compiled(frame.replace("{name}", f"(?:{name})")))
        for priority, confidence, word, frame in FRAMES
        for label, keyword, name in FAMILIES
    ]
    return named + [Rule(label, keywords_of(pattern), *KINDS[kind], compiled(pattern)) for kind, label, pattern in SIGNATURES]


@functools.lru_cache(maxsize=1)
def keywords() -> ahocorasick.Automaton:
    """Finds all keywords in one pass over a text of one-byte characters, each with the rules that it is the first one of."""
    found: dict[bytes, list[Rule]] = {k: [] for rule in rules() for k in rule.keywords}
    for rule in rules():
        found[rule.keywords[0]].append(rule)
    automaton = ahocorasick.Automaton()
    for keyword, own in found.items():
        automaton.add_word(keyword.decode("latin-1"), (keyword, own))
    automaton.make_automaton()
    return automaton


@functools.lru_cache(maxsize=1)
def phrase_patterns() -> list[tuple[str, bytes, re.Pattern[bytes]]]:
    """(label, a word of it, pattern whose empty match marks each place, any signs between words) of each phrase."""
    out = []
    for phrase, label in PHRASES.items():
        words = phrase.split()
        body = f"{GAP}+".join(words)
        out.append((label, max(words, key=len).encode(), re.compile(f"(?<!{WORD})(?=({body})(?!{WORD}))".encode("latin-1"))))
    return out


@dataclass(frozen=True)
class Detection:
    start: int
    stop: int
    priority: int
    confidence: float
    label: str


def base_detections(text: bytes) -> list[Detection]:
    """All places of the phrases in lowered text."""
    return [
        Detection(*m.span(1), 100, 1.0, label)
        for label, word, pattern in phrase_patterns()
        if word in text
        for m in pattern.finditer(text)
    ]


def detections(text: bytes) -> list[Detection]:
    """Resolved detections of lowered text, by place."""
    found = base_detections(text)
    held = dict(hit for _, hit in keywords().iter(text.decode("latin-1")))
    for own in held.values():
        for rule in own:
            if all(k in held for k in rule.keywords):
                found += [Detection(*m.span(), rule.priority, rule.confidence, rule.label) for m in rule.pattern.finditer(text)]
    return resolved(found)


def resolved(found: list[Detection]) -> list[Detection]:
    """Drops what lies inside a detection that comes before it in order of priority, length and place.

    Accepted intervals are kept apart by priority level 100 (phrases, which never drop each other).
    """
    order = sorted(found, key=lambda d: (-d.priority, d.start - d.stop, d.start, d.label))
    starts: list[int] = []  # of accepted intervals that lie in no other, in order; their stops ascend too
    stops: list[int] = []
    kept: list[Detection] = []
    for d in order:
        at = int(np.searchsorted(starts, d.start, side="right")) if starts else 0
        if d.priority < 100 and at and stops[at - 1] >= d.stop:
            continue
        kept.append(d)
        if not at or stops[at - 1] < d.stop:
            end = at
            while end < len(starts) and stops[end] <= d.stop:
                end += 1
            begin = at - 1 if at and starts[at - 1] == d.start else at
            starts[begin:end], stops[begin:end] = [d.start], [d.stop]
    return sorted(kept, key=lambda d: (d.start, d.stop, d.label))


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<start:long,stop:long,label:string>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """A row per row of `docs`; `spans` are the resolved detections as byte offsets of the UTF-8 text."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = [*one_column(part.column("text"))]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 4, *[pa.string()] * 2, pa.float64(), span_type))]
                names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    def one_column(column: pa.Array) -> Iterator[tuple]:
        data, ends = byte_view(column)
        data = _LOWER[data]
        inside = _IN_WORD[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        if len(data):
            edges = ends[:-1][ends[:-1] < len(data)]
            begins[edges] = inside[edges]
        word_at = np.flatnonzero(begins)
        first_of = np.searchsorted(word_at, ends)
        raw = data.tobytes()
        for k, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
            found = detections(raw[a:b])
            base = [d for d in found if d.priority == 100]
            places = [int(np.searchsorted(word_at, a + d.start)) - int(first_of[k]) for d in base]
            yield (
                int(first_of[k + 1] - first_of[k]), len(base), min(places, default=None), max(places, default=None),
                ",".join(sorted({d.label for d in base})), ",".join(sorted({d.label for d in found})),
                max((d.confidence for d in found), default=0.0), [{"start": d.start, "stop": d.stop, "label": d.label} for d in found],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).drop("spans")
