from tests.llm.corpus import docs, no_docs  # noqa: F401
