"""One plan per measure family, and the report that puts them together."""
