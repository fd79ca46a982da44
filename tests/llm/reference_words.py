"""Words as the plain definition gives them."""

import re


def spaced(text, fold=False):
    if fold:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
