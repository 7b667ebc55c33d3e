"""Operators for preparing training corpora (documents in, documents or
reports out). Nothing else in the library imports this subpackage."""
