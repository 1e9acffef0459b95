"""Made-up prose."""

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ilex juniper katsura larch maple nutmeg oak pine quince rowan spruce teak".split()


def prose(seed: int, n: int) -> str:
    """n words in sentences of 4 to 9, as good as unique for each seed."""
    out, x, left = [], seed * 2654435761 % 2**32, 0
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % 2**32
        word = WORDS[x >> 27 & 15] + WORDS[x >> 11 & 15][:3]
        if not left:
            left, word = 4 + (x >> 20) % 6, word.capitalize()
        left -= 1
        out.append(word if left else word + ".")
    return " ".join(out)
