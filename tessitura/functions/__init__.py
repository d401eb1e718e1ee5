"""Part of tessitura; see README.md."""
