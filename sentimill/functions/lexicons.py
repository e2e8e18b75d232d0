"""Lexicons the text chain looks tokens up in.

The emoticon and acronym tables are FIXED VALUES: they must equal the lexicons the
original application ships for cleaned text to come out the same. They are kept here as
plain data in their original order. Any other table with the same two columns can be
passed instead (see ``sentimill.functions.text``).
"""

from __future__ import annotations

# --- FIXED VALUES: emoticon -> sentiment word (token matched exactly, case-sensitive) ---
EMOTICONS: list[tuple[str, str]] = [
    (':-)', 'smile'),
    (':)', 'smile'),
    (':D', 'smile'),
    (':o)', 'smile'),
    (':]', 'smile'),
    (':3', 'smile'),
    (':c)', 'smile'),
    (': >', 'smile'),
    ('=]', 'smile'),
    ('8)', 'smile'),
    ('=)', 'smile'),
    (':}', 'smile'),
    (':^', 'smile'),
    ('):', 'smile'),
    (':-))', 'happy'),
    (':-D', 'laughing'),
    ('8-D', 'laughing'),
    ('8D', 'laughing'),
    ('x-D', 'laughing'),
    ('xD', 'laughing'),
    ('X-D', 'laughing'),
    ('XD', 'laughing'),
    ('=-D', 'laughing'),
    ('=D', 'laughing'),
    ('=-3', 'laughing'),
    ('= 3', 'laughing'),
    ('B^D', 'laughing'),
    ('>:[', 'sad'),
    (':-(', 'sad'),
    (':(', 'sad'),
    (':-c', 'sad'),
    (':c', 'sad'),
    (':-<', 'sad'),
    (':<', 'sad'),
    (':-[', 'sad'),
    (':[', 'sad'),
    (':{', 'sad'),
    (';(', 'sad'),
    (':-||', 'angry'),
    (':@', 'angry'),
    ('>:(', 'angry'),
    (":'-(", 'crying'),
    (":'(", 'crying'),
    (":'-)", 'happiness'),
    (":')", 'happiness'),
    ('D:<', 'horror'),
    ('D:', 'horror'),
    ('D;', 'disgust'),
    ('v.v', 'sadness'),
    ('>:O', 'surprise'),
    (':-O', 'surprise'),
    (':O', 'surprise'),
    (':-o', 'surprise'),
    (':o', 'surprise'),
    ('8-0', 'surprise'),
    ('O_O', 'shock'),
    ('o-o', 'shock'),
    ('O_o', 'shock'),
    ('o_O', 'shock'),
    ('o_o', 'shock'),
    ('O-O', 'shock'),
    ('=o=', 'yawn'),
    (':*', 'kiss'),
    (':-*', 'kiss'),
    (':^*', 'kiss'),
    (';-)', 'wink'),
    (';)', 'wink'),
    ('*-)', 'wink'),
    ('*)', 'wink'),
    (';-]', 'wink'),
    (';]', 'wink'),
    (';D', 'wink'),
    (';^', 'wink'),
    ('):-,', 'wink'),
    ('>:P', 'tongue'),
    (':-P', 'playful'),
    (':P', 'playful'),
    ('X-P', 'playful'),
    ('x-p', 'playful'),
    ('xp', 'playful'),
    ('XP', 'playful'),
    (':-p', 'playful'),
    (':p', 'playful'),
    ('=p', 'playful'),
    (':-b', 'playful'),
    (':b', 'playful'),
    ('d:', 'playful'),
    ('>:\\', 'skeptical'),
    ('>:/', 'skeptical'),
    (':-/', 'skeptical'),
    (':-.', 'skeptical'),
    (':/', 'skeptical'),
    (':\\', 'skeptical'),
    ('=/', 'skeptical'),
    ("='", 'skeptical'),
    (':L', 'skeptical'),
    ('=L', 'skeptical'),
    (':S', 'annoyed'),
    ('>.<', 'annoyed'),
    (':|', 'indecision'),
    (':-|', 'indecision'),
    (':$', 'embarrassed'),
    (':-X', 'sealed lips'),
    (':X', 'sealed lips'),
    (':-#', 'sealed lips'),
    (':#', 'sealed lips'),
    ('O:-)', 'angel'),
    ('0:-3', 'angel'),
    ('0:3', 'angel'),
    ('0:-)', 'angel'),
    ('0:)', 'angel'),
    ('0;^)', 'angel'),
    ('>:)', 'evil'),
    ('>;)', 'evil'),
    ('>:-)', 'evil'),
    ('}:-)', 'devilish'),
    ('}:)', 'devilish'),
    ('3:-)', 'devilish'),
    ('3:)', 'devilish'),
    ('o/\\o', 'high five'),
    ('^5', 'high five'),
    ('>_> ^ ^ <_<', 'high five'),
    ('|;-)', 'cool'),
    ('|-O', 'cool'),
    (':-J', 'tongue-in-cheek'),
    (':-&: &', 'tongue-tied'),
    ('#-)', 'partied all night'),
    ('%-)', 'drunk'),
    ('%)', 'drunk'),
    (':-###..', 'being sick'),
    (':###..', 'being sick'),
    ('<:-|', 'dumb'),
    ('\\o/', 'cheer'),
    ('*\\0/*', 'cheerleader'),
    ("@}-;-'---", 'rose'),
    ('@>-->--', 'rose'),
    ('<3', 'heart'),
    ('</3', 'broken-heart'),
    ('(>_<)', 'troubled'),
    ('( > _ <)>', 'troubled'),
    ("(';')", 'baby'),
    ('(_^;)', 'embarrassed'),
    ('(-_-;)', 'nervous'),
    ('(~_~;)', 'nervous'),
    ('^^;', 'shy'),
    ('^_^;', 'shy'),
    ('(^.^#)', 'shy'),
    ('(^ ^;)', 'shy'),
    ('(-_ -)zzz', 'sleeping'),
    ('(^_-)', 'wink'),
    ('((+_ +))', 'confused'),
    ('(+o+)', 'confused'),
    ('^_^', 'joyful'),
    ('(^_^)/', 'joyful'),
    ('(^O^)/', 'joyful'),
    ('(^o^)/', 'joyful'),
    ('(^^)/', 'joyful'),
    ('^^', 'joyful'),
    ('(__)', 'respect'),
    ('_(._.)_', 'respect'),
    ('_(_^_)_', 'respect'),
    ('_<(__)>', 'respect'),
    ('<m(__)m>', 'respect'),
    ('m(__)m', 'respect'),
    ("('_')", 'sad'),
    ('(/_;)', 'sad'),
    ('(T_T)', 'sad'),
    ('(;_;)', 'sad'),
    ('(;_; ', 'sad'),
    ('(;_:)', 'sad'),
    ('(;O;)', 'sad'),
    ('(:_;)', 'sad'),
    ('(ToT)', 'sad'),
    (';_;', 'sad'),
    (';-;', 'sad'),
    (';n;', 'sad'),
    (';;', 'sad'),
    ('Q.Q', 'sad'),
    ('T.T', 'sad'),
    ('QQ', 'sad'),
    ('Q_Q', 'sad'),
    ('(-.-)', 'shame'),
    ('(-_ -)', 'shame'),
    ('(=_=)', 'tired'),
    ('=^_^=', 'cat'),
    ('(..)', 'looking down'),
    ('(._.)', 'looking down'),
    ('(?_?)', 'confusion'),
]

# --- FIXED VALUES: acronym (upper case) -> expansion ---
ACRONYMS: list[tuple[str, str]] = [
    ('BD', 'big deal'),
    ('BF', 'boyfriend'),
    ('BRB', 'be right back'),
    ('BTW', 'by the way'),
    ('GF', 'girlfriend'),
    ('HBD', 'happy birthday'),
    ('JK', 'just kidding'),
    ('KK', 'cool'),
    ('LMK', 'let me know'),
    ('LOL', 'laugh out loud'),
    ('MYOB', 'mind your own business'),
    ('NBD', 'no big deal'),
    ('NVM', 'nevermind'),
    ('OBV', 'obviously'),
    ('OBVI', 'obviously'),
    ('OMG', 'oh my God'),
    ('PLS', 'please'),
    ('PLZ', 'please'),
    ('QQ', 'quick question'),
    ('RLY', 'really'),
    ('SRLSY', 'seriously'),
    ('TMI', 'too much information'),
    ('TY', 'thank you'),
    ('TYVM', 'thank you very much'),
    ('YW', 'you are welcome'),
    ('FOMO', 'fear of missing out'),
    ('FTFY', 'fixed this for you'),
    ('FTW', 'for the win'),
    ('FYA', 'for your amusement'),
    ('FYE', 'for your entertainment'),
    ('GTI', 'going through it'),
    ('HTH', 'here to help'),
    ('IRL', 'in real life'),
    ('ICYMI', 'in case you missed it'),
    ('ICYWW', 'in case you were wondering'),
    ('NBC', 'nobody cares though'),
    ('NTW', 'not to worry'),
    ('OTD', 'of the day'),
    ('OOTD', 'outfit of the day'),
    ('QOTD', 'quote of the day'),
    ('FOTD', 'find of the day'),
    ('YOLO', 'you only live once'),
    ('ZOMG', 'oh my god, but, like, more emphatic'),
    ('AFAIK', 'as far as i Know'),
    ('DGYF', 'dang girl you fine'),
    ('FWIW', "for what it's worth"),
    ('IDC', "i don't care"),
    ('IDK', "i don't know"),
    ('FYI', 'for your information'),
    ('IIRC', 'if i remember correctly'),
    ('IMHO', 'in my honest opinion'),
    ('IMO', 'in my opinion'),
    ('JELL', 'jealous'),
    ('JSYK', 'just so you know'),
    ('LMAO', 'laughing my ass off'),
    ('LMFAO', 'laughing my fucking ass off'),
    ('NTS', 'note to self'),
    ('ROFL', 'rolling on the floor laughing'),
    ('ROFLMAO', 'rolling on the floor laughing my ass off'),
    ('SMH', 'shaking my head'),
    ('TBH', 'to be honest'),
    ('TL', 'too long'),
    ('DR', "didn't read"),
    ('YGTR', 'you got that right'),
    ('AYKMWTS', 'are you kidding me with this shit?'),
    ('BAMF', 'bad ass mother fucker'),
    ('FFS', "for fuckin's sake"),
    ('FML', 'fuck my life'),
    ('HYFR', 'hell yeah fucking right'),
    ('IDGAF', "i don't give a fuck"),
    ('NFW', 'no fucking way'),
    ('PITA', 'pain in the ass'),
    ('POS', 'piece of shit'),
    ('SOL', 'shit outta luck'),
    ('STFU', 'shut the fuck up'),
    ('TF', 'the fuck'),
    ('WTF', 'What The Fuck'),
    ('BFN', 'bye for now'),
    ('CU', 'see you'),
    ('CYL', 'see you later'),
    ('GTG', 'got to go'),
    ('OMW', 'on my way'),
    ('RN', 'right now'),
    ('TTYL', 'talk to you later'),
    ('TYT', 'take your time'),
    ('CC', 'carbon copy'),
    ('CX', 'correction'),
    ('DM', 'direct message'),
    ('FB', 'facebook'),
    ('#FBF', 'flash-back friday'),
    ('#FF', 'follow friday'),
    ('HT', 'hat tip'),
    ('IG', 'instagram'),
    ('MT', 'modified tweet'),
    ('OH', 'overheard'),
    ('PRT', 'partial retweet'),
    ('RT', 'retweet'),
    ('SO', 'shout out'),
    ('AWOL', 'away while online'),
    ('BFF', 'best friend forever'),
    ('NSFW', 'not safe for work'),
    ('OG', 'original gangster'),
    ('PSA', 'public service announcement'),
    ('PDA', 'public display of affection'),
    ('#TBT', 'throw-back thursday'),
]

# Default stop words: a short general English list written for this package. Pass a
# one-word-per-line file to ``load_stop_words`` to use any other list (for example the
# 670-word list the original application reads from disk).
DEFAULT_STOP_WORDS: list[str] = """
a about above after again against all am an and any are as at be because been before
being below between both but by can could did do does doing down during each few for
from further had has have having he her here hers herself him himself his how i if in
into is it its itself just me more most my myself no nor not now of off on once only or
other our ours ourselves out over own same she should so some such than that the their
theirs them themselves then there these they this those through to too under until up
very was we were what when where which while who whom why will with would you your
yours yourself yourselves
""".split()


def html_entities() -> list[tuple[str, str]]:
    """Named character references understood by the unescape step.

    The rule: every HTML 4 entity name (the standard library's ``name2codepoint``
    table, 252 names) plus ``apos``. Names are case-sensitive.
    """
    from html.entities import name2codepoint

    pairs = [(name, chr(cp)) for name, cp in name2codepoint.items()]
    pairs.append(("apos", "'"))
    return sorted(pairs)
