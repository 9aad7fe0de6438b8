"""Training-data operators (packing, chat, language, URL, HTML, dedup, rules, licences).

Self-contained: nothing outside this subpackage imports it, apart from the
guarded import in ``__spark_entry__``.
"""
