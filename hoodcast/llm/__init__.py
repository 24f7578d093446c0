"""Training-data operators: language ID, packing, decontamination, set-similarity
join, web archive, chat formatting, line dedup, quality rules, substring dedup
and a quality classifier.

Nothing outside this subpackage imports it. ``registry`` lists the queries.
"""
