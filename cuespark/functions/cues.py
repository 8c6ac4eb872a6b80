"""Word lists and character sets.

The first block holds fixed values that must equal the ones the negation-cue
features are defined with; results depend on them verbatim.
"""

import string

# ---------------------------------------------------------------------------
# Fixed values (must match the feature definitions exactly)
# ---------------------------------------------------------------------------
NEG_PREFIXES = ["un", "in", "im", "il", "dis", "ir", "non"]
NEG_SUFFIX = "less"
INFIX_ENDINGS = ["lessness", "lessly"]
ONE_WORD_CUES = ["no", "not", "nor", "neither", "non", "without", "never", "cannot",
                 "n't", "none", "nothing", "nobody", "nowhere"]
MULTI_WORD_CUES = ["no longer", "by no means", "not for the world", "on the contrary",
                   "rather than", "nothing at all", "no more"]
PUNCTUATION = string.punctuation  # the 32 ASCII punctuation characters
NGRAM_SIZE = 5
LABELS = ["B-NEG", "I-NEG", "O"]

# Token pattern: a run of letters/digits, or one character that is neither a
# letter, a digit nor white space.  Same text in Java regex and RE2.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"

# ---------------------------------------------------------------------------
# Cue lists for the synthetic test corpus.  The lists above barely occur in
# its invented prose, so the test queries pass these to get non-constant
# results.
# ---------------------------------------------------------------------------
TEST_ONE_WORD_CUES = ["no", "without", "is", "was", "worthless"]
TEST_MULTI_WORD_CUES = ["of the", "in the", "it is", "the of it", ". the of",
                        "the and attion to", "to to to to"]
TEST_LONG_CUES = ["the the the the the", "of the in the of", "orre orre orre orre orre orre orre", "the of the"]
