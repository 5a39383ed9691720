"""A stand-in for the conversion service: web pages to markdown, by substitution.

The real service is whatever call a user passes to ``python_converter``; this one exists so that the
whole path can run without a network.
"""

from __future__ import annotations

# Substitutions that turn a web page into markdown, applied in this order.
MARKDOWN_RULES = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?s)<head>.*?</head>", ""),
    (r"(?s)<script>.*?</script>", ""),
    (r"<h1>", "\n\n# "),
    (r"<li>", "\n- "),
    (r"</?b>", "**"),
    (r"<br>|<p>|</p>|</h1>|</ul>|</div>", "\n\n"),
    (r"<[^>]*>", ""),
    (r"&quot;", '"'),
    (r"&copy;", "(c)"),
    (r"&middot;", "-"),
    (r"&amp;", "&"),
    (r"[ \t]*\n[ \t]*", "\n"),
    (r"\n\n+", "\n\n"),
    (r"^\n+|\n+$", ""),
)


def open_html_service(rules: tuple[tuple[str, str], ...] = MARKDOWN_RULES):
    """A service for ``python_converter``; self-contained, so that it needs no package on the workers."""

    def open_service():
        import base64
        import json
        import re

        compiled = [(re.compile(pattern), replacement) for pattern, replacement in rules]

        def call(payload, page_number, mode):
            text = base64.b64decode(payload).decode("utf-8")
            for pattern, replacement in compiled:
                text = pattern.sub(replacement, text)
            answer = {"content": text, "confidence": {"parse_score": 1.0, "ocr_score": "nan"}}
            return 200, json.dumps({"value": json.dumps(answer)})

        return call

    return open_service
