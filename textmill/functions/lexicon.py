"""Word lists and letter tables used by the text functions."""

from __future__ import annotations

import unicodedata

# The 50 tags kept by the cleaning step.
ALLOWED_TAGS = [
    "javascript", "java", "c#", "php", "android", "jquery", "python", "html", "c++", "ios", "mysql", "css", "sql",
    "asp.net", "objective-c", "ruby-on-rails", ".net", "c", "iphone", "arrays", "angularjs", "sql-server", "ruby",
    "json", "ajax", "regex", "r", "xml", "asp.net-mvc", "node.js", "linux", "django", "wpf", "database", "xcode",
    "vb.net", "eclipse", "string", "swift", "windows", "excel", "wordpress", "html5", "spring", "multithreading",
    "facebook", "image", "forms", "git", "oracle",
]

# The ten tags of the smaller study set.
STUDY_TAGS = ["javascript", "java", "c#", "php", "python", "android", "jquery", "html", "c++", "ios"]

# Common English function words.
STOP_WORDS = [
    "a", "about", "above", "across", "after", "again", "against", "all", "almost", "along", "already", "also",
    "although", "always", "am", "among", "an", "and", "another", "any", "anyone", "anything", "are", "around", "as",
    "at", "back", "be", "became", "because", "been", "before", "behind", "being", "below", "between", "both", "but",
    "by", "ca", "can", "cannot", "could", "did", "do", "does", "doing", "done", "down", "during", "each", "either",
    "else", "enough", "even", "ever", "every", "everything", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "hence", "her", "here", "hers", "herself", "him", "himself", "his", "how", "however", "i", "if",
    "in", "indeed", "into", "is", "it", "its", "itself", "just", "least", "less", "many", "may", "me", "might",
    "mine", "more", "most", "much", "must", "my", "myself", "neither", "never", "no", "nobody", "none", "nor", "not",
    "nothing", "now", "of", "off", "often", "on", "once", "only", "onto", "or", "other", "others", "our", "ours",
    "ourselves", "out", "over", "own", "per", "perhaps", "quite", "rather", "really", "same", "sha", "she", "should",
    "since", "so", "some", "something", "still", "such", "than", "that", "the", "their", "theirs", "them",
    "themselves", "then", "there", "these", "they", "this", "those", "through", "to", "together", "too", "under",
    "until", "up", "upon", "us", "very", "via", "was", "we", "were", "what", "when", "where", "whether", "which",
    "while", "who", "whom", "whose", "why", "will", "with", "within", "without", "wo", "would", "yet", "you", "your",
    "-pron-",
]

# Words that read as numbers.
NUMBER_WORDS = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
    "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty",
    "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion", "trillion",
]

# Irregular word forms and their dictionary form.
LEMMAS = {
    "began": "begin", "begun": "begin", "bought": "buy", "broke": "break", "broken": "break", "brought": "bring",
    "built": "build", "came": "come", "caught": "catch", "children": "child", "chose": "choose", "chosen": "choose",
    "feet": "foot", "fell": "fall", "felt": "feel", "found": "find", "gave": "give", "given": "give", "gone": "go",
    "got": "get", "gotten": "get", "grew": "grow", "held": "hold", "indices": "index", "kept": "keep", "knew": "know",
    "known": "know", "led": "lead", "lost": "lose", "made": "make", "matrices": "matrix", "men": "man",
    "mice": "mouse", "people": "people", "ran": "run", "said": "say", "sang": "sing", "saw": "see", "seen": "see",
    "sent": "send", "shown": "show", "sold": "sell", "spent": "spend", "stood": "stand", "taken": "take",
    "taught": "teach", "teeth": "tooth", "threw": "throw", "thrown": "throw", "told": "tell", "took": "take",
    "understood": "understand", "vertices": "vertex", "went": "go", "women": "woman", "won": "win", "wrote": "write",
    "written": "write",
}

# Letters without a decomposition that become one or more ASCII characters.
SPECIAL_LETTERS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d",
    "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i", "ŋ": "ng", "Ŋ": "NG",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "–": "-", "—": "--", "…": "...", "•": "*",
    "«": "<<", "»": ">>", "€": "EUR", "£": "PS", "©": "(c)", "®": "(r)", "™": "tm", "·": "*", "°": "deg",
    " ": " ",
}

# HTML entities decoded after the tags are gone; '&amp;' comes last so that '&amp;lt;' gives '&lt;'.
HTML_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©",
    "&reg;": "®", "&middot;": "·", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—", "&laquo;": "«",
    "&raquo;": "»", "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&euro;": "€",
    "&pound;": "£", "&deg;": "°", "&bull;": "•", "&trade;": "™", "&amp;": "&",
}


def accent_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to, multi): one-to-one letters for ``translate`` and letters that grow to several characters.

    Built by rule: every Latin letter of the first extended blocks whose compatibility decomposition starts with
    ASCII letters is replaced by those letters, combining marks are dropped.
    """
    source, target, multi = [], [], {}
    blocks = list(range(0xC0, 0x250)) + list(range(0x1E00, 0x1F00))
    for code in blocks:
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        plain = SPECIAL_LETTERS.get(letter, base)
        if not plain.isascii() or not plain or plain == letter:
            continue
        if len(plain) == 1:
            source.append(letter)
            target.append(plain)
        else:
            multi[letter] = plain
    for letter, plain in SPECIAL_LETTERS.items():
        if letter in source or letter in multi:
            continue
        if len(plain) == 1:
            source.append(letter)
            target.append(plain)
        else:
            multi[letter] = plain
    return "".join(source), "".join(target), multi
