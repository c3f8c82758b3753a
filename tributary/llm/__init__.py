"""Operations for preparing training text: deduplication, scoring, scanning, search and mixing."""
