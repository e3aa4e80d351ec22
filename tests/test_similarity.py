from cohortrec.operators.similarity import cosine_similarity, rating_vectors


def test_given_pairs(spark):
    rows = [(1, 1, 3), (1, 2, 4), (2, 1, 3), (2, 3, 4), (3, 1, 0), (4, 9, 5)]
    vectors = rating_vectors(spark.createDataFrame(rows, "user_id long, movie_id long, rating int"))
    pairs = spark.createDataFrame([(1, 2), (1, 1), (3, 4), (1, 4), (1, 77)], "left_id long, right_id long")
    found = {(r.left_id, r.right_id): r.similarity for r in cosine_similarity(vectors, pairs).collect()}
    assert found == {(1, 2): 9 / 25, (1, 1): 1.0, (3, 4): None, (1, 4): 0.0, (1, 77): None}


def test_one_rating_per_coordinate(spark):
    ratings = spark.createDataFrame([(1, 5, 2), (1, 5, 4)], "user_id long, movie_id long, rating int")
    assert [tuple(r) for r in rating_vectors(ratings).collect()] == [(1, 5, 3.0)]
