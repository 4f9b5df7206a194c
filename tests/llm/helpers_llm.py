"""Helpers that tests import."""


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
