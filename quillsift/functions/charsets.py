"""Fixed values shared by the operators and by their SQL checks."""

# Blanks that split and strip treat as white space.
BLANK_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
BLANKS = "".join(chr(c) for low, high in BLANK_RANGES for c in range(low, high + 1))
BLANK_CLASS = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in BLANK_RANGES)

# Control and line separators that cleaning turns into one space.
SEPARATOR_CLASS = r"\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"

# Punctuation counted per message, with the name used in its column.
PUNCTUATION = {
    "!": "exclaim", '"': "dquote", "#": "hash", "$": "dollar", "%": "percent", "&": "amp",
    "'": "squote", "(": "lparen", ")": "rparen", "*": "asterisk", "+": "plus", ",": "comma",
    "-": "hyphen", ".": "period", "/": "slash", ":": "colon", ";": "semicolon", "<": "lt",
    "=": "eq", ">": "gt", "?": "question", "@": "at", "[": "lbracket", "\\": "backslash",
    "]": "rbracket", "^": "caret", "_": "underscore", "`": "backtick", "{": "lbrace",
    "|": "pipe", "}": "rbrace", "~": "tilde",
}

# English stop words as listed by Spark ML.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an
the and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll
they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()
