from snowloom.llm import decontaminate


def test_a_fit_cuts_every_text_into_words_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    item = "which river crosses the old town of bern and where does it turn north? the aare"
    rows = [(i, item if i == 7 else None if i == 8 else f"plain words about river and town number {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(counted, "doc_id long, text string")
    space = decontaminate.fit(docs, [decontaminate.Item(1, decontaminate.words(item), decontaminate.answer(item))], [item])
    assert seen.value == 50
    found = space.search([text for _, text in rows])
    assert [i for i, f in enumerate(found) if f] == [7] and found[7][0][1] > 0.9
