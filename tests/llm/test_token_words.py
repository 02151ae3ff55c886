import random
import unicodedata

from gleaner.llm import token_files as tf


def test_words_equal_the_tokenizer():
    """Words of Latin letters with marks, composed and not, in both cases,
    with signs, digits, other scripts and special tokens inside."""
    enc = tf.Encoder(tf.default_tokenizer())
    assert enc.latin
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x20, 0x300) if chr(c).isprintable() and not chr(c).isspace()]
    odd = letters + list("日本ж\u0301\u0308ﬁǅß\u0130ıſ") + ["<|endoftext|>", "<|", "é", "ñ", "'s"]
    for k in range(4000):
        pool = rng.choice([odd, "abcdefghijklmnop", "aéñüßçøœ", "aéÉÑñ.,!"])
        word = "".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))
        word = rng.choice([word, word.lower(), unicodedata.normalize("NFD", word), unicodedata.normalize("NFC", word)])
        if not word.split() or len(word.split()) > 1:
            continue
        assert enc.word(word.encode()) == enc._whole(word), ascii(word)
