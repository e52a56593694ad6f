from placeloom.llm.names import near


def test_edits_of_words_that_meet_again_are_not_counted_again():
    assert near("harbour", "harbuor", 2) == 1 and near("harbour", "harbour", 0) == 0 and near("harbour", "market", 2) == 3
    before = near.cache_info()
    assert near("harbour", "harbuor", 2) == 1 and near.cache_info().hits == before.hits + 1 and before.maxsize is not None
