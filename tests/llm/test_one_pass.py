"""A text is one call of the tokenizer's library."""
import numpy as np
import public_tokenizers
import tokenizers

from pagewright.llm import packing


def test_a_text_is_one_call_of_the_library():
    encoder, asked = packing.Ids(public_tokenizers.path("byte_bpe_50k.tiktoken")), []
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library = encoder.encoding

    class Counting:
        def encode_to_numpy(self, text, **options):
            asked.append(text)
            return library.encode_to_numpy(text, **options)

    encoder.encoding = Counting()
    texts = ["", "two words", "a  b \n\n c  d  \x85e", "x<|endoftext|> y", "漢字 😀é" * 50, " " * 3000 + "end", "!?" * 900]
    for text in texts:
        found = np.frombuffer(encoder.of(text), "<u4").tolist()
        assert found == plain.encode(text, add_special_tokens=False).ids, text[:20]
    assert asked == texts
