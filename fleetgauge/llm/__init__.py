"""Operations of a training-data pipeline: language, quality, copies, search, mixing, scoring."""
