"""License signatures, written by hand: (label, keyword, regex, priority, score).

A regex is over the normal form of a text: its words, lower-cased, with single spaces. It's tried only where the keyword occurs, which every match holds.
Priorities: 1 a bare mention of a family, 2 a name, 3 a name with more, 4 a version, 5 a sentence that puts something under a license, 6 such a sentence with a
version, 7 a passage of a license's own text or notice, 8 a machine-readable tag.
"""

LICENSE = "licen[cs]e"

SIGNATURES = [
    # MIT and its relatives
    ("mit", "mit licen", "mit licen[cs]e", 2, 0.85),
    ("mit", "mit licen", "(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit licen[cs]e", 5, 0.98),
    ("mit", "mit licensed", "mit licensed", 3, 0.85),
    ("mit", "expat licen", "expat licen[cs]e", 2, 0.85),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 7, 0.99),
    ("mit", "the software is provided", "the software is provided as is without warranty of any kind express or implied", 7, 0.9),
    ("mit", "above copyright notice and this permission", "the above copyright notice and this permission notice shall be included in all copies", 7, 0.97),
    ("mit", "opensource org licenses mit", "opensource org licenses mit(?: license(?: php)?)?", 8, 0.98),
    ("mit-0", "mit no attribution", "mit no attribution(?: licen[cs]e)?", 4, 0.95),
    ("mit-0", "mit 0", "mit 0 licen[cs]e", 4, 0.9),
    ("x11", "x11 licen", "x11 licen[cs]e", 2, 0.85),
    ("x11", "x consortium", "mit x consortium licen[cs]e", 3, 0.9),
    ("hpnd", "historical permission notice", "historical permission notice and disclaimer", 3, 0.95),
    # BSD
    ("bsd", "bsd licen", "bsd licen[cs]e", 2, 0.75),
    ("bsd", "bsd style", "bsd style licen[cs]e", 3, 0.75),
    ("bsd", "bsd", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?bsd licen[cs]e", 5, 0.9),
    ("bsd-2-clause", "2 clause bsd", "2 clause bsd(?: licen[cs]e)?", 4, 0.95),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2 clause(?: licen[cs]e)?", 4, 0.95),
    ("bsd-2-clause", "simplified bsd", "simplified bsd licen[cs]e", 4, 0.95),
    ("bsd-2-clause", "freebsd licen", "freebsd licen[cs]e", 4, 0.9),
    ("bsd-3-clause", "3 clause bsd", "3 clause bsd(?: licen[cs]e)?", 4, 0.95),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3 clause(?: licen[cs]e)?", 4, 0.95),
    ("bsd-3-clause", "new bsd", "new bsd licen[cs]e", 4, 0.95),
    ("bsd-3-clause", "modified bsd", "modified bsd licen[cs]e", 4, 0.95),
    ("bsd-3-clause", "revised bsd", "revised bsd licen[cs]e", 4, 0.95),
    ("bsd-3-clause", "neither the name of", "neither the name of (?:\\S+ ){1,12}may be used to endorse or promote products", 7, 0.97),
    ("bsd-4-clause", "original bsd", "original bsd licen[cs]e", 4, 0.9),
    ("bsd-4-clause", "bsd 4 clause", "bsd 4 clause(?: licen[cs]e)?", 4, 0.95),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software", 7, 0.97),
    ("0bsd", "0bsd", "0bsd(?: licen[cs]e)?", 4, 0.9),
    ("0bsd", "zero clause bsd", "zero clause bsd(?: licen[cs]e)?", 4, 0.95),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", 7, 0.95),
    ("bsd", "redistributions of source code", "redistributions of source code must retain the above copyright notice", 7, 0.93),
    # ISC, zlib, Boost and other short permissive licenses
    ("isc", "isc licen", "isc licen[cs]e", 2, 0.85),
    ("isc", "isc licen", "(?:licensed|released|distributed) under (?:the )?(?:terms of the )?isc licen[cs]e", 5, 0.97),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose", 7, 0.98),
    ("zlib", "zlib", "zlib licen[cs]e", 2, 0.85),
    ("zlib", "zlib", "zlib libpng licen[cs]e", 3, 0.9),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such", 7, 0.98),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented", 7, 0.97),
    ("libpng", "libpng licen", "libpng licen[cs]e", 2, 0.85),
    ("bsl-1.0", "boost software", "boost software licen[cs]e", 2, 0.9),
    ("bsl-1.0", "boost software", "boost software licen[cs]e version 1 0", 4, 0.98),
    ("bsl-1.0", "boost software", "(?:licensed|distributed|use modification and distribution (?:is|are) subject to)(?: under)?(?: the)? boost software licen[cs]e(?: version 1 0)?", 6, 0.99),
    ("ncsa", "ncsa open source", "(?:university of illinois )?ncsa open source licen[cs]e", 3, 0.95),
    ("postgresql", "postgresql licen", "postgresql licen[cs]e", 2, 0.9),
    ("python-2.0", "python software foundation", "python software foundation licen[cs]e(?: version 2)?", 3, 0.95),
    ("python-2.0", "psf licen", "psf licen[cs]e(?: agreement)?", 3, 0.9),
    ("php-3.01", "php licen", "php licen[cs]e(?: version 3 0?1)?", 3, 0.9),
    ("ruby", "ruby licen", "ruby licen[cs]e", 2, 0.85),
    ("vim", "vim licen", "vim licen[cs]e", 2, 0.85),
    ("curl", "curl licen", "curl licen[cs]e", 2, 0.85),
    ("openssl", "openssl licen", "openssl licen[cs]e", 2, 0.85),
    ("openssl", "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit", 7, 0.98),
    ("w3c", "w3c", "w3c software (?:notice and licen[cs]e|and document notice and licen[cs]e|licen[cs]e)", 3, 0.95),
    ("unicode", "unicode licen", "unicode licen[cs]e(?: agreement)?", 3, 0.9),
    ("icu", "icu licen", "icu licen[cs]e", 2, 0.85),
    ("json", "good not evil", "the software shall be used for good not evil", 7, 0.99),
    ("beerware", "beer", "beerware(?: licen[cs]e)?", 2, 0.85),
    ("beerware", "buy me a beer", "you can buy me a beer in return", 7, 0.97),
    ("upl-1.0", "universal permissive", "universal permissive licen[cs]e(?: version)?(?: 1 0)?", 4, 0.95),
    ("afl-3.0", "academic free", "academic free licen[cs]e(?: version | v ?| )3 0", 4, 0.97),
    ("afl", "academic free", "academic free licen[cs]e", 2, 0.85),
    ("ecl-2.0", "educational community", "educational community licen[cs]e(?: version)?(?: 2 0)?", 4, 0.95),
    ("ftl", "freetype", "freetype (?:project )?licen[cs]e", 2, 0.9),
    ("ijg", "independent jpeg group", "based in part on the work of the independent jpeg group", 7, 0.97),
    ("blue-oak-1.0.0", "blue oak", "blue oak model licen[cs]e(?: 1 0 0)?", 4, 0.95),
    ("mulan-psl-2.0", "mulan", "mulan (?:psl|permissive software licen[cs]e)(?: v2| version 2)?", 4, 0.95),
    # Apache
    ("apache", "apache licen", "apache licen[cs]e", 2, 0.8),
    ("apache", "apache software licen", "apache software licen[cs]e", 2, 0.8),
    ("apache-2.0", "apache licen", "apache licen[cs]e v?2(?: 0)?", 4, 0.95),
    ("apache-2.0", "apache licen", "apache licen[cs]e version 2(?: 0)?", 4, 0.97),
    ("apache-2.0", "apache 2", "apache 2 0 licen[cs]e", 4, 0.95),
    ("apache-2.0", "asl 2", "asl 2 0", 4, 0.8),
    ("apache-2.0", "apache licen", "licensed under the apache licen[cs]e version 2 0(?: the license)?", 6, 0.99),
    ("apache-2.0", "apache", "(?:released|distributed|available|published) under (?:the )?(?:terms of the )?apache (?:software )?licen[cs]e(?: version | v ?| )2 0", 6, 0.98),
    ("apache-2.0", "apache org licenses", "apache org licenses license 2 0", 8, 0.98),
    ("apache-2.0", "you may not use this file", "you may not use this file except in compliance with the license", 7, 0.95),
    ("apache-2.0", "on an as is basis", "distributed on an as is basis without warranties or conditions of any kind", 7, 0.95),
    ("apache-1.1", "apache software licen", "apache software licen[cs]e version 1 1", 4, 0.97),
    ("apache-1.0", "apache licen", "apache licen[cs]e(?: version)? 1 0", 4, 0.95),
    # GPL
    ("gpl", "general public licen", "general public licen[cs]e", 1, 0.7),
    ("gpl", "gnu general public", "gnu general public licen[cs]e", 2, 0.8),
    ("gpl", "gnu gpl", "gnu gpl", 2, 0.75),
    ("gpl", "gpl licen", "gpl licen[cs]ed?", 2, 0.75),
    ("gpl-1.0", "general public licen", "(?:gnu )?general public licen[cs]e(?: version | v ?)1(?: 0)?", 4, 0.95),
    ("gpl-2.0", "general public licen", "(?:gnu )?general public licen[cs]e(?: version | v ?)2(?: 0)?", 4, 0.97),
    ("gpl-2.0", "gplv2", "gplv2", 3, 0.9),
    ("gpl-2.0", "gpl v2", "gpl v2", 3, 0.9),
    ("gpl-2.0", "gpl 2 0", "gpl 2 0(?: only)?", 3, 0.9),
    ("gpl-2.0-or-later", "general public licen", "(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2(?: of the license)? or (?:at your option )?any later version", 6, 0.99),
    ("gpl-2.0-or-later", "gplv2 or later", "gplv2 or later", 4, 0.95),
    ("gpl-2.0-or-later", "gpl 2 0 or later", "gpl 2 0 or later", 4, 0.95),
    ("gpl-3.0", "general public licen", "(?:gnu )?general public licen[cs]e(?: version | v ?)3(?: 0)?", 4, 0.97),
    ("gpl-3.0", "gplv3", "gplv3", 3, 0.9),
    ("gpl-3.0", "gpl v3", "gpl v3", 3, 0.9),
    ("gpl-3.0", "gpl 3 0", "gpl 3 0(?: only)?", 3, 0.9),
    ("gpl-3.0-or-later", "general public licen", "(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or (?:at your option )?any later version", 6, 0.99),
    ("gpl-3.0-or-later", "gplv3 or later", "gplv3 or later", 4, 0.95),
    ("gpl-3.0-or-later", "gpl 3 0 or later", "gpl 3 0 or later", 4, 0.95),
    ("gpl", "general public licen", "(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?(?:gnu )?general public licen[cs]e", 5, 0.92),
    ("gpl", "free software you can", "is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 6, 0.97),
    ("gpl", "received a copy of the gnu general", "you should have received a copy of the gnu general public licen[cs]e", 7, 0.95),
    ("gpl", "without even the implied warranty", "without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", 7, 0.9),
    ("gpl-linking-exception", "linking exception", "(?:gpl )?linking exception", 3, 0.85),
    ("gpl-classpath-exception", "classpath exception", "classpath exception", 3, 0.9),
    ("gpl-gcc-exception", "gcc runtime library exception", "gcc runtime library exception", 3, 0.95),
    # LGPL and AGPL
    ("lgpl", "lesser general public", "(?:gnu )?lesser general public licen[cs]e", 3, 0.88),
    ("lgpl", "library general public", "(?:gnu )?library general public licen[cs]e", 3, 0.88),
    ("lgpl", "gnu lgpl", "gnu lgpl", 2, 0.8),
    ("lgpl-2.0", "library general public", "(?:gnu )?library general public licen[cs]e(?: version | v ?)2(?: 0)?", 5, 0.97),
    ("lgpl-2.1", "lesser general public", "(?:gnu )?lesser general public licen[cs]e(?: version | v ?)2 1", 5, 0.97),
    ("lgpl-2.1", "lgplv2 1", "lgplv2 1", 3, 0.9),
    ("lgpl-2.1", "lgpl 2 1", "lgpl 2 1(?: only)?", 3, 0.9),
    ("lgpl-2.1-or-later", "lesser general public", "(?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2 1(?: of the license)? or (?:at your option )?any later version", 6, 0.99),
    ("lgpl-2.1-or-later", "lgpl 2 1 or later", "lgpl 2 1 or later", 4, 0.95),
    ("lgpl-3.0", "lesser general public", "(?:gnu )?lesser general public licen[cs]e(?: version | v ?)3(?: 0)?", 5, 0.97),
    ("lgpl-3.0", "lgplv3", "lgplv3", 3, 0.9),
    ("lgpl-3.0", "lgpl 3 0", "lgpl 3 0(?: only)?", 3, 0.9),
    ("lgpl-3.0-or-later", "lesser general public", "(?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or (?:at your option )?any later version", 6, 0.99),
    ("lgpl", "lesser general public", "(?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:gnu )?lesser general public licen[cs]e", 5, 0.95),
    ("agpl", "affero general public", "(?:gnu )?affero general public licen[cs]e", 3, 0.9),
    ("agpl-3.0", "affero general public", "(?:gnu )?affero general public licen[cs]e(?: version | v ?)3(?: 0)?", 5, 0.97),
    ("agpl-3.0", "agplv3", "agplv3", 3, 0.9),
    ("agpl-3.0", "agpl 3 0", "agpl 3 0(?: only)?", 3, 0.9),
    ("agpl-3.0-or-later", "affero general public", "(?:gnu )?affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or (?:at your option )?any later version", 6, 0.99),
    ("agpl", "affero general public", "(?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:gnu )?affero general public licen[cs]e", 5, 0.95),
    ("agpl-1.0", "affero general public", "affero general public licen[cs]e version 1", 5, 0.95),
    ("fdl", "free documentation", "(?:gnu )?free documentation licen[cs]e", 2, 0.88),
    ("fdl-1.2", "free documentation", "(?:gnu )?free documentation licen[cs]e version 1 2", 4, 0.97),
    ("fdl-1.3", "free documentation", "(?:gnu )?free documentation licen[cs]e version 1 3", 4, 0.97),
    ("fdl", "invariant sections", "with no invariant sections no front cover texts and no back cover texts", 7, 0.98),
    ("copyleft", "copyleft", "copyleft", 1, 0.4),
    # other reciprocal licenses
    ("mpl", "mozilla public", "mozilla public licen[cs]e", 2, 0.85),
    ("mpl-1.0", "mozilla public", "mozilla public licen[cs]e(?: version | v ?| )1 0", 4, 0.97),
    ("mpl-1.1", "mozilla public", "mozilla public licen[cs]e(?: version | v ?| )1 1", 4, 0.97),
    ("mpl-2.0", "mozilla public", "mozilla public licen[cs]e(?: version | v ?| )2 0", 4, 0.97),
    ("mpl-2.0", "mpl 2 0", "mpl 2 0", 3, 0.9),
    ("mpl-2.0", "mozilla public", "this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0", 7, 0.99),
    ("mpl-2.0", "mozilla org mpl", "mozilla org mpl 2 0", 8, 0.97),
    ("npl-1.1", "netscape public", "netscape public licen[cs]e(?: version)?(?: 1 1)?", 4, 0.95),
    ("epl", "eclipse public", "eclipse public licen[cs]e", 2, 0.85),
    ("epl-1.0", "eclipse public", "eclipse public licen[cs]e(?: version | v ?| )1 0", 4, 0.97),
    ("epl-2.0", "eclipse public", "eclipse public licen[cs]e(?: version | v ?| )2 0", 4, 0.97),
    ("epl-2.0", "epl 2 0", "epl 2 0", 3, 0.85),
    ("edl-1.0", "eclipse distribution", "eclipse distribution licen[cs]e(?:(?: version | v ?| )1 0)?", 4, 0.95),
    ("cddl", "common development and distribution", "common development and distribution licen[cs]e", 2, 0.88),
    ("cddl-1.0", "common development and distribution", "common development and distribution licen[cs]e(?: cddl)?(?: version | v ?| )1 0", 4, 0.97),
    ("cddl-1.1", "common development and distribution", "common development and distribution licen[cs]e(?: cddl)?(?: version | v ?| )1 1", 4, 0.97),
    ("cpl-1.0", "common public licen", "common public licen[cs]e(?:(?: version | v ?| )1 0)?", 4, 0.95),
    ("cpal-1.0", "common public attribution", "common public attribution licen[cs]e(?: version)?(?: 1 0)?", 4, 0.95),
    ("ipl-1.0", "ibm public licen", "ibm public licen[cs]e(?: version)?(?: 1 0)?", 4, 0.95),
    ("eupl", "european union public", "european union public licen[cs]e", 2, 0.88),
    ("eupl-1.1", "european union public", "european union public licen[cs]e(?: eupl)?(?: version | v ?| )1 1", 4, 0.97),
    ("eupl-1.2", "european union public", "european union public licen[cs]e(?: eupl)?(?: version | v ?| )1 2", 4, 0.97),
    ("cecill-2.1", "cecill", "cecill(?: free software)? licen[cs]e(?: agreement)?(?:(?: version | v ?| )2 1)?", 4, 0.93),
    ("cecill-b", "cecill b", "cecill b(?: licen[cs]e)?", 4, 0.93),
    ("cecill-c", "cecill c", "cecill c(?: licen[cs]e)?", 4, 0.93),
    ("artistic", "artistic licen", "artistic licen[cs]e", 2, 0.85),
    ("artistic-1.0", "artistic licen", "artistic licen[cs]e(?: version)? 1 0", 4, 0.95),
    ("artistic-2.0", "artistic licen", "artistic licen[cs]e(?: version)? 2(?: 0)?", 4, 0.97),
    ("perl", "same terms as perl", "under the same terms as perl(?: itself)?", 5, 0.95),
    ("osl", "open software licen", "open software licen[cs]e", 2, 0.85),
    ("osl-2.1", "open software licen", "open software licen[cs]e(?: version | v ?| )2 1", 4, 0.96),
    ("osl-3.0", "open software licen", "open software licen[cs]e(?: version | v ?| )3 0", 4, 0.97),
    ("ms-pl", "microsoft public", "microsoft public licen[cs]e", 3, 0.93),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[cs]e", 3, 0.93),
    ("qpl-1.0", "q public licen", "q public licen[cs]e(?: version)?(?: 1 0)?", 4, 0.95),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e", 2, 0.88),
    ("apsl-2.0", "apple public source", "apple public source licen[cs]e(?: version)?(?: 2 0)?", 4, 0.95),
    ("rpl-1.5", "reciprocal public", "reciprocal public licen[cs]e(?: version)?(?: 1 5)?", 4, 0.95),
    ("lppl-1.3c", "latex project public", "latex project public licen[cs]e(?: version)?(?: 1 3c?)?", 4, 0.95),
    # source-available
    ("busl-1.1", "business source", "business source licen[cs]e(?: version)?(?: 1 1)?", 4, 0.95),
    ("sspl-1.0", "server side public", "server side public licen[cs]e(?:(?: version | v ?| )1)?", 4, 0.95),
    ("elastic-2.0", "elastic licen", "elastic licen[cs]e(?:(?: version | v ?| )2 0)?", 4, 0.93),
    ("commons-clause", "commons clause", "commons clause(?: license condition)?", 3, 0.93),
    ("polyform-noncommercial", "polyform noncommercial", "polyform noncommercial licen[cs]e(?: 1 0 0)?", 4, 0.95),
    ("polyform-shield", "polyform shield", "polyform shield licen[cs]e(?: 1 0 0)?", 4, 0.95),
    ("polyform-small-business", "polyform small business", "polyform small business licen[cs]e(?: 1 0 0)?", 4, 0.95),
    ("rsal", "redis source available", "redis source available licen[cs]e(?: v?2)?", 4, 0.93),
    ("confluent", "confluent community", "confluent community licen[cs]e", 3, 0.93),
    ("parity-7.0.0", "parity public", "parity public licen[cs]e(?: 7 0 0)?", 4, 0.93),
    ("openrail", "openrail", "(?:creativeml )?openrail(?: m)?(?: licen[cs]e)?", 3, 0.9),
    ("hippocratic", "hippocratic", "hippocratic licen[cs]e(?: 2 1| 3 0)?", 3, 0.93),
    # public domain and its like
    ("public-domain", "public domain", "public domain", 1, 0.6),
    ("public-domain", "public domain", "(?:is|are) in the public domain", 3, 0.85),
    ("public-domain", "public domain", "(?:released|dedicated|placed|put) (?:in|into|to) the public domain", 5, 0.95),
    ("public-domain", "public domain", "public domain mark(?: 1 0)?", 4, 0.95),
    ("public-domain", "no known copyright", "no known copyright(?: restrictions)?", 3, 0.85),
    ("public-domain", "united states government work", "united states government work", 3, 0.85),
    ("unlicense", "unlicense", "(?:the )?unlicense", 2, 0.85),
    ("unlicense", "unencumbered software", "free and unencumbered software released into the public domain", 7, 0.99),
    ("wtfpl", "wtfpl", "wtfpl", 2, 0.9),
    ("wtfpl", "do what the", "do what the \\S+ you want to public licen[cs]e", 4, 0.97),
    ("cc0-1.0", "cc0", "cc0", 2, 0.88),
    ("cc0-1.0", "cc0", "cc0(?: version)? 1 0(?: universal)?", 4, 0.95),
    ("cc0-1.0", "creative commons zero", "creative commons zero(?: (?:version )?1 0)?", 4, 0.95),
    ("cc0-1.0", "publicdomain zero", "creativecommons org publicdomain zero 1 0", 8, 0.99),
    ("cc0-1.0", "waived all copyright", "has waived all copyright and related or neighboring rights", 7, 0.97),
    ("pddl-1.0", "public domain dedication", "(?:open data commons )?public domain dedication and licen[cs]e(?: version)?(?: 1 0)?", 4, 0.96),
    # Creative Commons
    ("cc", "creative commons", "creative commons", 1, 0.6),
    ("cc", "creative commons", "(?:licensed|released|distributed|available|published) under (?:a|the) creative commons licen[cs]e", 3, 0.8),
    ("cc-by", "cc by", "cc by", 2, 0.9),
    ("cc-by", "creative commons attribution", "creative commons attribution", 2, 0.88),
    ("cc-by-1.0", "cc by", "cc by 1 0", 4, 0.95),
    ("cc-by-2.0", "cc by", "cc by 2 0", 4, 0.95),
    ("cc-by-2.5", "cc by", "cc by 2 5", 4, 0.95),
    ("cc-by-3.0", "cc by", "cc by 3 0", 4, 0.95),
    ("cc-by-4.0", "cc by", "cc by 4 0", 4, 0.95),
    ("cc-by-3.0", "creative commons attribution", "creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?", 4, 0.98),
    ("cc-by-4.0", "creative commons attribution", "creative commons attribution 4 0(?: international)?(?: licen[cs]e)?", 4, 0.98),
    ("cc-by-4.0", "creativecommons org licenses by 4", "creativecommons org licenses by 4 0", 8, 0.99),
    ("cc-by-3.0", "creativecommons org licenses by 3", "creativecommons org licenses by 3 0", 8, 0.99),
    ("cc-by-sa", "cc by sa", "cc by sa", 3, 0.92),
    ("cc-by-sa", "creative commons attribution", "creative commons attribution share ?alike", 3, 0.92),
    ("cc-by-sa-2.0", "cc by sa", "cc by sa 2 0", 5, 0.95),
    ("cc-by-sa-2.5", "cc by sa", "cc by sa 2 5", 5, 0.95),
    ("cc-by-sa-3.0", "cc by sa", "cc by sa 3 0", 5, 0.95),
    ("cc-by-sa-4.0", "cc by sa", "cc by sa 4 0", 5, 0.95),
    ("cc-by-sa-3.0", "creative commons attribution", "creative commons attribution share ?alike(?: licen[cs]e)?(?: version)? 3 0(?: unported)?", 5, 0.98),
    ("cc-by-sa-4.0", "creative commons attribution", "creative commons attribution share ?alike(?: licen[cs]e)?(?: version)? 4 0(?: international)?", 5, 0.98),
    ("cc-by-sa-4.0", "creativecommons org licenses by sa 4", "creativecommons org licenses by sa 4 0", 8, 0.99),
    ("cc-by-sa-3.0", "creativecommons org licenses by sa 3", "creativecommons org licenses by sa 3 0", 8, 0.99),
    ("cc-by-nc", "cc by nc", "cc by nc", 3, 0.92),
    ("cc-by-nc", "creative commons attribution", "creative commons attribution non ?commercial", 3, 0.92),
    ("cc-by-nc-3.0", "cc by nc", "cc by nc 3 0", 5, 0.95),
    ("cc-by-nc-4.0", "cc by nc", "cc by nc 4 0", 5, 0.95),
    ("cc-by-nc-4.0", "creative commons attribution", "creative commons attribution non ?commercial(?: licen[cs]e)? 4 0(?: international)?", 5, 0.98),
    ("cc-by-nd", "cc by nd", "cc by nd", 3, 0.92),
    ("cc-by-nd", "creative commons attribution", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?", 3, 0.92),
    ("cc-by-nd-3.0", "cc by nd", "cc by nd 3 0", 5, 0.95),
    ("cc-by-nd-4.0", "cc by nd", "cc by nd 4 0", 5, 0.95),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa", 4, 0.94),
    ("cc-by-nc-sa", "creative commons attribution", "creative commons attribution non ?commercial share ?alike", 4, 0.94),
    ("cc-by-nc-sa-3.0", "cc by nc sa", "cc by nc sa 3 0", 6, 0.96),
    ("cc-by-nc-sa-4.0", "cc by nc sa", "cc by nc sa 4 0", 6, 0.96),
    ("cc-by-nc-sa-4.0", "creative commons attribution", "creative commons attribution non ?commercial share ?alike(?: licen[cs]e)? 4 0(?: international)?", 6, 0.98),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd", 4, 0.94),
    ("cc-by-nc-nd", "creative commons attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?", 4, 0.94),
    ("cc-by-nc-nd-3.0", "cc by nc nd", "cc by nc nd 3 0", 6, 0.96),
    ("cc-by-nc-nd-4.0", "cc by nc nd", "cc by nc nd 4 0", 6, 0.96),
    ("cc-by-nc-nd-4.0", "creative commons attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: licen[cs]e)? 4 0(?: international)?", 6, 0.98),
    # fonts, data and government works
    ("ofl-1.1", "open font licen", "(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?", 4, 0.96),
    ("ofl-1.1", "reserved font name", "with reserved font name", 7, 0.95),
    ("gust-font", "gust font licen", "gust font licen[cs]e", 3, 0.93),
    ("bitstream-vera", "bitstream vera", "bitstream vera(?: fonts)? (?:copyright|licen[cs]e)", 3, 0.9),
    ("odbl-1.0", "open database licen", "open (?:data commons open )?database licen[cs]e(?: odbl)?(?: v?1 0)?", 4, 0.96),
    ("odbl-1.0", "odbl", "odbl", 2, 0.85),
    ("odc-by-1.0", "open data commons attribution", "open data commons attribution licen[cs]e(?: v?1 0)?", 4, 0.96),
    ("cdla-permissive", "community data licen", "community data licen[cs]e agreement permissive(?: version)?(?: [12] 0)?", 4, 0.96),
    ("cdla-sharing", "community data licen", "community data licen[cs]e agreement sharing(?: version)?(?: 1 0)?", 4, 0.96),
    ("ogl-uk-3.0", "open government licen", "open government licen[cs]e(?: v?3 0)?", 4, 0.93),
    ("ogl-uk-3.0", "public sector information", "contains public sector information licensed under the open government licen[cs]e", 7, 0.97),
    ("etalab-2.0", "licence ouverte", "licence ouverte(?: open licence)?(?: version)?(?: 2 0)?", 4, 0.93),
    ("dl-de-by-2.0", "datenlizenz deutschland", "datenlizenz deutschland(?: namensnennung)?(?: version)?(?: 2 0)?", 4, 0.93),
    ("crown-copyright", "crown copyright", "crown copyright(?: reserved)?", 3, 0.85),
    ("openstreetmap", "openstreetmap contributors", "openstreetmap contributors", 3, 0.85),
    # rights kept
    ("reserved", "all rights reserved", "all rights reserved", 3, 0.9),
    ("some-rights-reserved", "some rights reserved", "some rights reserved", 3, 0.8),
    ("no-rights-reserved", "no rights reserved", "no rights reserved", 3, 0.85),
    ("reserved", "alle rechte vorbehalten", "alle rechte vorbehalten", 3, 0.9),
    ("reserved", "tous droits r", "tous droits réservés", 3, 0.9),
    ("reserved", "todos los derechos reservados", "todos los derechos reservados", 3, 0.9),
    ("reserved", "derechos reservados", "derechos reservados", 2, 0.8),
    ("reserved", "tutti i diritti riservati", "tutti i diritti riservati", 3, 0.9),
    ("reserved", "todos os direitos reservados", "todos os direitos reservados", 3, 0.9),
    ("reserved-notice", "copyright", "copyright (?:c )?[0-9]{4}(?: [0-9]{4})?(?: \\S+){1,4} all rights reserved", 4, 0.95),
    ("reserved", "reproduction in whole or in part", "reproduction in whole or in part without (?:written )?permission is (?:strictly )?prohibited", 5, 0.95),
    ("reserved", "may not be published broadcast", "this material may not be published broadcast rewritten or redistributed", 7, 0.97),
    ("reserved", "no part of this", "no part of this (?:publication|book|document|work) may be reproduced", 7, 0.96),
    ("reserved", "unauthorized reproduction", "unauthorized reproduction(?: or distribution)?(?: is)?(?: strictly)? prohibited", 5, 0.93),
    ("reserved", "do not copy or distribute", "do not copy or distribute", 3, 0.8),
    ("used-with-permission", "permission", "(?:re)?(?:printed|produced|used) with (?:the )?permission(?: of)?", 3, 0.75),
    ("used-by-permission", "by permission of", "(?:re)?(?:printed|produced|used) by permission of", 3, 0.75),
    ("proprietary", "confidential and proprietary", "confidential and proprietary", 4, 0.92),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", 4, 0.92),
    ("proprietary", "proprietary licen", "proprietary licen[cs]e", 3, 0.85),
    ("proprietary", "proprietary information", "contains (?:confidential )?proprietary information", 4, 0.85),
    ("proprietary", "trade secret", "trade secrets? of", 3, 0.75),
    ("commercial", "commercial licen", "commercial licen[cs]e(?: agreement)?", 2, 0.8),
    ("commercial", "valid licence", "requires a valid licence", 2, 0.7),
    ("commercial", "valid license", "requires a valid license", 2, 0.7),
    ("commercial", "per seat", "licensed per seat", 2, 0.7),
    ("eula", "end user licen", "end user licen[cs]e agreement", 3, 0.9),
    ("eula", "by installing", "by installing (?:copying )?or (?:otherwise )?using (?:the|this) software(?: product)? you agree", 7, 0.92),
    ("eula", "software is licensed not sold", "(?:the|this) software is licensed not sold", 7, 0.95),
    ("eula", "reverse engineer", "you may not reverse engineer decompile or disassemble", 7, 0.93),
    ("terms-of-use", "terms of use", "subject to (?:the|our) terms of use", 3, 0.75),
    ("terms-of-service", "terms of service", "subject to (?:the|our) terms of service", 3, 0.75),
    ("non-commercial", "non commercial use only", "(?:for )?non commercial use only", 4, 0.88),
    ("non-commercial", "noncommercial use only", "(?:for )?noncommercial use only", 4, 0.88),
    ("non-commercial", "no commercial use", "no commercial use", 4, 0.85),
    ("non-commercial", "not for commercial use", "not for commercial use", 4, 0.88),
    ("non-commercial", "use only", "for (?:your )?personal(?: and)?(?: non ?commercial)? use only", 4, 0.85),
    ("non-commercial", "purposes only", "for (?:academic|research|educational)(?: (?:and|or) (?:academic|research|educational))? purposes only", 4, 0.85),
    ("evaluation-only", "evaluation purposes only", "for evaluation purposes only", 4, 0.88),
    ("internal-use", "internal use only", "for internal use only", 3, 0.8),
    ("fair-use", "fair use", "(?:used )?under (?:the )?fair use", 3, 0.8),
    ("fair-use", "fair use notice", "fair use notice", 3, 0.85),
    ("fair-dealing", "fair dealing", "(?:under|for the purposes? of) fair dealing", 3, 0.8),
    ("dmca", "digital millennium copyright act", "digital millennium copyright act", 2, 0.6),
    # tags
    ("apache-2.0", "spdx license identifier", "spdx license identifier apache 2 0", 8, 1.0),
    ("mit", "spdx license identifier", "spdx license identifier mit", 8, 1.0),
    ("isc", "spdx license identifier", "spdx license identifier isc", 8, 1.0),
    ("zlib", "spdx license identifier", "spdx license identifier zlib", 8, 1.0),
    ("bsl-1.0", "spdx license identifier", "spdx license identifier bsl 1 0", 8, 1.0),
    ("unlicense", "spdx license identifier", "spdx license identifier unlicense", 8, 1.0),
    ("bsd-2-clause", "spdx license identifier", "spdx license identifier bsd 2 clause", 8, 1.0),
    ("bsd-3-clause", "spdx license identifier", "spdx license identifier bsd 3 clause", 8, 1.0),
    ("gpl-2.0", "spdx license identifier", "spdx license identifier gpl 2 0(?: only)?", 8, 1.0),
    ("gpl-2.0-or-later", "spdx license identifier", "spdx license identifier gpl 2 0 or later", 9, 1.0),
    ("gpl-3.0", "spdx license identifier", "spdx license identifier gpl 3 0(?: only)?", 8, 1.0),
    ("gpl-3.0-or-later", "spdx license identifier", "spdx license identifier gpl 3 0 or later", 9, 1.0),
    ("lgpl-2.1", "spdx license identifier", "spdx license identifier lgpl 2 1(?: only)?", 8, 1.0),
    ("lgpl-2.1-or-later", "spdx license identifier", "spdx license identifier lgpl 2 1 or later", 9, 1.0),
    ("lgpl-3.0", "spdx license identifier", "spdx license identifier lgpl 3 0(?: only)?", 8, 1.0),
    ("agpl-3.0", "spdx license identifier", "spdx license identifier agpl 3 0(?: only)?", 8, 1.0),
    ("mpl-2.0", "spdx license identifier", "spdx license identifier mpl 2 0", 8, 1.0),
    ("epl-2.0", "spdx license identifier", "spdx license identifier epl 2 0", 8, 1.0),
    ("cc0-1.0", "spdx license identifier", "spdx license identifier cc0 1 0", 8, 1.0),
    ("cc-by-4.0", "spdx license identifier", "spdx license identifier cc by 4 0", 8, 1.0),
    ("cc-by-sa-4.0", "spdx license identifier", "spdx license identifier cc by sa 4 0", 8, 1.0),
    ("ofl-1.1", "spdx license identifier", "spdx license identifier ofl 1 1", 8, 1.0),
]

#: Words one of which every keyword above holds; a text without any of them is not looked at further.
ROOTS = [
    "licen", "copyright", "copyleft", "rights", "rechte", "droits", "derechos", "diritti", "direitos", "public", "cc by", "cc0", "creative", "gpl", "bsd", "mit 0", "mit no", "permission",
    "redistribut", "software", "warranty", "notice", "proprietary", "commercial", "confidential", "fair", "use only", "purposes only", "terms", "trade secret", "reproduc", "copy", "beer", "wtfpl", "odbl", "mpl 2", "epl 2",
    "asl 2", "apache", "exception", "invariant", "cecill", "openrail", "creativecommons", "datenlizenz", "openstreetmap", "neither the name", "materials", "good not evil", "jpeg", "do what the",
    "same terms", "you may not", "as is", "may not be", "no part of", "by permission", "reverse engineer", "per seat", "by installing", "unencumbered", "source", "reserved", "x consortium", "x11", "bitstream", "mulan", "w3c", "openssl",
    "united states", "commons", "implied", "font", "sspl", "government", "mozilla", "zlib", "academic free", "blue oak", "common development", "community", "eclipse", "free documentation", "freetype",
    "hippocratic", "microsoft", "polyform", "sleepycat", "universal permissive",
]
