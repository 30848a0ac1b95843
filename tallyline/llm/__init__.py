"""Operations on large text corpora: counting, matching, cleaning, mixing and archiving documents."""
