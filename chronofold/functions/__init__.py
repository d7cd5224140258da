"""Part of chronofold; see README.md."""
