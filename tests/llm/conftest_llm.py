"""Small helpers of the tests in this folder."""


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
