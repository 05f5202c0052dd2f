"""File trees."""

from pyspark.sql import functions as F

from checks.registry import query
from estate.operators import files, ranges
from estate.session import scratch_path
from estate.sources import listings


#: Documents that one task writes as files.
FILES_PER_TASK = 2000


def _tree_writer(local_paths: bool):
    """A function (path, content) that leaves a file as Spark's writers do: whole or not at all, on mounts with a checksum file.

    Made inside a function, so that Spark sends it by value.
    """
    open_path, folders = listings.path_opener(local_paths), set()

    def put(filesystem, folder: str, name: str, content: bytes) -> None:
        import uuid

        from pyarrow import fs

        if not isinstance(filesystem, fs.LocalFileSystem):
            with filesystem.open_output_stream(f"{folder}/{name}") as out:
                out.write(content)
            return
        partial = f"{folder}/.{name}.{uuid.uuid4().hex}.partial"
        with open(partial, "wb") as out:
            out.write(content)
        filesystem.move(partial, f"{folder}/{name}")

    def write(path: str, content: bytes) -> None:
        import struct
        import zlib

        from pyarrow import fs

        filesystem, inner = open_path(path)
        folder, _, name = inner.rpartition("/")
        if folder not in folders:
            filesystem.create_dir(folder, recursive=True)
            folders.add(folder)
        if isinstance(filesystem, fs.LocalFileSystem):
            sums = [zlib.crc32(content[i : i + 512]) for i in range(0, len(content), 512)]
            put(filesystem, folder, f".{name}.crc", struct.pack(f">4si{len(sums)}I", b"crc\0", 512, *sums))
        put(filesystem, folder, name, content)

    return write


def _tree(inputs):
    """The documents as a file tree, one document per file, as ``partitionBy("source", "lang").text()`` leaves them.

    Workers write the files themselves: Spark's writer starts processes for the permissions of each file on a mount, and
    its driver renames them one after the other. Rows are in order inside a task, so that a repeated or
    speculative task gives every file the same name and content.
    """
    path, write = scratch_path(inputs.spark, "tree"), _tree_writer(listings.is_local(inputs.spark))

    def save(batches):
        import re

        import pyarrow as pa

        special, seen = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""), {}

        def part(name: str, value: str | None) -> str:
            return f"{name}=" + (special.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__")

        for batch in batches:
            for source, lang, text, task in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = f"{path}/{part('source', source)}/{part('lang', lang)}"
                seen[folder] = n = seen.get(folder, -1) + 1
                write(f"{folder}/part-{task:05d}.c{n:03d}.txt", (text or b"") + b"\n")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    rows = inputs("documents").select("source", "lang", F.col("text").cast("binary").alias("value"))
    tasks = max(8, -(-rows.count() // FILES_PER_TASK))
    dealt = rows.repartition(tasks).sortWithinPartitions("source", "lang", "value").withColumn("task", F.spark_partition_id())
    dealt.mapInArrow(save, "files long").agg(F.sum("files")).first()
    write(f"{path}/_SUCCESS", b"")
    return path


def _data_files(rows):
    """Without the marker and checksum files that the writer leaves beside the documents."""
    return rows.filter(~F.regexp_extract("relpath", "([^/]*)$", 1).rlike("^[._]"))


@query(
    "list_tree",
    "SELECT 'source=' || source || '/lang=' || lang AS folder, count(*) AS files, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM {documents} GROUP BY ALL",
)
def _(inputs):
    found = _data_files(listings.list_tree(inputs.spark, _tree(inputs)))
    folder = F.regexp_extract("relpath", "^(.*)/[^/]*$", 1)
    return found.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


_PAIRED = """SELECT coalesce(s.volume, t.volume) AS volume, coalesce(s.relpath, t.relpath) AS relpath, s.relpath IS NOT NULL AS in_s, t.relpath IS NOT NULL AS in_t,
  s.size AS s_size, t.size AS t_size, s.content_hash AS s_hash, t.content_hash AS t_hash
FROM {files} s FULL OUTER JOIN {copied_files} t ON s.volume = t.volume AND s.relpath = t.relpath"""


def _kinds(value: str) -> str:
    return f"""SELECT *, CASE WHEN NOT in_t THEN 'missing' WHEN NOT in_s THEN 'extra' WHEN s_{value} <> t_{value} THEN 'mismatch' END AS difference FROM ({_PAIRED})"""


def _summary(value: str, bytes_too: bool) -> str:
    lists = ", ".join(
        f"coalesce(array_to_string(list_slice(list(relpath ORDER BY relpath) FILTER (WHERE difference = '{d}'), 1, 5), ','), '') AS {d}" for d in ("missing", "extra", "mismatch")
    )
    counts = ", ".join(f"count(*) FILTER (WHERE difference = '{d}') AS {d}_files" for d in ("missing", "extra", "mismatch"))
    sums = ", CAST(coalesce(sum(s_size), 0) AS BIGINT) AS source_bytes, CAST(coalesce(sum(t_size), 0) AS BIGINT) AS target_bytes" if bytes_too else ""
    return f"""SELECT volume, count(*) FILTER (WHERE in_s) AS source_files, count(*) FILTER (WHERE in_t) AS target_files, {counts}{sums},
  count(difference) = 0 AS match, {lists} FROM ({_kinds(value)}) GROUP BY volume"""


def _texts(rows):
    for kind in ("missing", "extra", "mismatch"):
        rows = rows.withColumn(kind, F.array_join(kind, ","))
    return rows.drop("duplicate_paths")


@query("compare_listings", _summary("size", True))
def _(inputs):
    return _texts(files.compare_listings(inputs("files"), inputs("copied_files"), keys=["volume"], evidence=5))


@query("compare_content_hashes", _summary("hash", False))
def _(inputs):
    return _texts(files.compare_hashes(inputs("files"), inputs("copied_files"), keys=["volume"], evidence=5))


def _all_differences(value: str) -> str:
    return f"SELECT volume, relpath, difference, s_{value} AS source_value, t_{value} AS target_value FROM ({_kinds(value)}) WHERE difference IS NOT NULL"


@query("listing_differences", _all_differences("size"))
def _(inputs):
    return files.listing_differences(inputs("files"), inputs("copied_files"), keys=["volume"])


@query("hash_differences", _all_differences("hash"))
def _(inputs):
    return files.hash_differences(inputs("files"), inputs("copied_files"), keys=["volume"])


@query("copy_pairs", "SELECT doc_id, '/mnt/old/' || volume || '/' || relpath AS src, '/mnt/new/' || relpath AS dst FROM {files}")
def _(inputs):
    pairs = files.copy_pairs(inputs("files"), source_root=F.concat(F.lit("/mnt/old/"), "volume", F.lit("//")), target_root="/mnt/new/")
    return pairs.select("doc_id", "src", "dst")


@query("resumable_copy_plan", f"SELECT volume, relpath, s_size AS size, in_t AND s_size = t_size AS done FROM ({_PAIRED}) WHERE in_s")
def _(inputs):
    return files.plan_copy(inputs("files"), inputs("copied_files"), keys=["volume"])


@query("copy_mode", "SELECT volume, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM {files} GROUP BY volume")
def _(inputs):
    return files.copy_mode(inputs("files"), keys=["volume"])


@query("copy_files", "SELECT 'copied' AS status, count(*) AS files, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM {documents}")
def _(inputs):
    source, target = _tree(inputs), scratch_path(inputs.spark, "copy")
    pairs = files.copy_pairs(_data_files(listings.list_tree(inputs.spark, source)), source_root=source, target_root=target)
    return files.copy_files(pairs, partitions=16).groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


# The tree also holds what the writer leaves beside the documents, so whole counts are compared.
@query("copy_and_verify", "SELECT count(*) AS documents, CAST(0 AS BIGINT) AS failed, TRUE AS all_copied, TRUE AS match FROM {documents}")
def _(inputs):
    source, target = _tree(inputs), scratch_path(inputs.spark, "copy")
    documents = _data_files(listings.list_tree(inputs.spark, source)).agg(F.count(F.lit(1)).alias("n")).scalar()
    verdict = files.copy_and_verify(inputs.spark, source, target, partitions=16)
    return verdict.select(
        documents.alias("documents"), "failed", (F.col("copied") == F.col("source_files")).alias("all_copied"), "match"
    )


# Where Spark's writer puts rows whose source is null; their tree has this key until the result.
_NO_SOURCE = "source=__HIVE_DEFAULT_PARTITION__"


def _named(rows):
    return rows.withColumn("tree", F.nullif("tree", F.lit(_NO_SOURCE)))


# Every source is a tree of its own; two more trees are absent and empty.
def _trees(inputs, *columns):
    base, target = _tree(inputs), scratch_path(inputs.spark, "copies")
    filesystem, empty = listings.path_opener(listings.is_local(inputs.spark))(f"{base}/empty")
    filesystem.create_dir(empty)
    names = inputs("documents").select(F.coalesce(F.concat(F.lit("source="), "source"), F.lit(_NO_SOURCE)).alias("tree")).distinct()
    names = names.unionByName(inputs.spark.createDataFrame([("absent",), ("empty",)], "tree string"))
    roots = {"root": base, "source_root": base, "target_root": target}
    return names.select("tree", *[F.concat(F.lit(roots[c] + "/"), "tree").alias(c) for c in columns])


_TREES = "SELECT 'source=' || source AS tree, count(*) AS files, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM {documents} GROUP BY source"


@query("list_trees", f"SELECT tree, 'present' AS state, files, bytes FROM ({_TREES}) UNION ALL SELECT 'absent', 'absent', 0, NULL UNION ALL SELECT 'empty', 'present', 0, NULL")
def _(inputs):
    listed = listings.list_trees(_trees(inputs, "root"), keys=["tree"])
    data = F.col("relpath").endswith(".txt")
    state = F.max(F.when(F.col("state") != "file", F.col("state"))).alias("state")
    return _named(listed.groupBy("tree").agg(state, F.count_if(data).alias("files"), F.sum(F.when(data, F.col("size"))).alias("bytes")))


@query(
    "copy_and_verify_trees",
    f"SELECT tree, 'present' AS source_state, files > 0 AS copied_all, TRUE AS match FROM ({_TREES}) UNION ALL SELECT 'absent', 'absent', TRUE, FALSE UNION ALL SELECT 'empty', 'present', TRUE, TRUE",
)
def _(inputs):
    verdict = files.copy_and_verify_trees(_trees(inputs, "source_root", "target_root"), keys=["tree"], partitions=16)
    return _named(verdict).select("tree", "source_state", (F.col("copied") == F.col("source_files")).alias("copied_all"), "match")


@query("tree_hashes", "SELECT 'source=' || source AS tree, md5(text || chr(10)) AS content_hash, count(*) AS files FROM {documents} GROUP BY ALL")
def _(inputs):
    hashes = files.tree_hashes(_trees(inputs, "root"), keys=["tree"], partitions=16).filter(F.col("relpath").endswith(".txt"))
    return _named(hashes.groupBy("tree", "content_hash").agg(F.count(F.lit(1)).alias("files")))


@query(
    "checksum_sample",
    "SELECT doc_id, relpath FROM {files} WHERE CAST(('0x' || substr(md5(relpath), 1, 8)) AS BIGINT) < 0.25 * 4294967295",
)
def _(inputs):
    return files.checksum_sample(inputs("files"), fraction=0.25).select("doc_id", "relpath")


@query("file_content_hashes", "SELECT md5(text || chr(10)) AS content_hash, count(*) AS files FROM {documents} GROUP BY ALL")
def _(inputs):
    hashes = _data_files(files.file_hashes(inputs.spark, _tree(inputs), partitions=16))
    return hashes.groupBy("content_hash").agg(F.count(F.lit(1)).alias("files"))


@query(
    "partition_file_parity",
    """SELECT volume, coalesce(s.part, t.part) AS partition, coalesce(s.n, 0) AS source_files, coalesce(t.n, 0) AS target_files, coalesce(s.n, 0) = coalesce(t.n, 0) AS match
FROM (SELECT volume, split_part(relpath, '/', 1) AS part, count(*) AS n FROM {files} GROUP BY ALL) s
FULL OUTER JOIN (SELECT volume, split_part(relpath, '/', 1) AS part, count(*) AS n FROM {copied_files} GROUP BY ALL) t USING (volume, part)""".replace(
        "coalesce(s.part, t.part)", "part"
    ),
)
def _(inputs):
    return files.partition_parity(inputs("files"), inputs("copied_files"), keys=["volume"])


@query("files_read", "SELECT DISTINCT o_orderpriority AS priority FROM {orders}")
def _(inputs):
    path = scratch_path(inputs.spark, "orders")
    inputs("orders").withColumn("folder", F.regexp_replace("o_orderpriority", "[^A-Z0-9]", "_")).write.partitionBy("folder").parquet(path)
    stored = inputs.spark.read.parquet(path)
    names = inputs("orders").select("o_orderpriority").distinct().select(
        F.col("o_orderpriority").alias("priority"), F.regexp_replace("o_orderpriority", "[^A-Z0-9]", "_").alias("folder")
    )
    read = listings.files_read(stored).select(F.regexp_extract("path", "folder=([^/]+)/", 1).alias("folder")).distinct()
    return names.join(read, "folder", "left_semi").select("priority")


# A tree three levels deep: documents by language and number, with one folder gone and one that is new.
_DEEP = "SELECT source AS volume, concat(lang, '/', doc_id % 7, '/', doc_id % 3, '/', doc_id, '.txt') AS relpath, n_chars AS size, md5(text) AS content_hash, doc_id FROM {documents}"
_DEEP_COPY = """SELECT source AS volume, concat(lang, '/', CASE WHEN doc_id % 7 = 5 AND doc_id % 3 = 1 THEN 'new/a' ELSE concat(doc_id % 7, '/', doc_id % 3) END, '/', doc_id, '.txt') AS relpath,
  CASE WHEN doc_id % 21 = 2 AND doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS size, md5(text) AS content_hash, doc_id FROM {documents} WHERE doc_id % 7 <> 3 OR doc_id % 3 <> 0"""
_ABOVE = """SELECT volume, relpath, size, unnest(range(0, len(string_split(relpath, '/')))) AS depth FROM ({tree}) t"""
_DIRS = """SELECT volume, array_to_string(string_split(relpath, '/')[1:depth], '/') AS directory, depth, count(*) AS files, list_sort(list(relpath || ':' || size)) AS content FROM ({above}) x GROUP BY ALL"""
_OF = lambda tree: _DIRS.replace("{above}", _ABOVE.replace("{tree}", tree))


@query(
    "directory_differences",
    f"""SELECT volume, directory, CASE WHEN t_files IS NULL THEN 'missing' WHEN s_files IS NULL THEN 'extra' ELSE 'mismatch' END AS difference, coalesce(s_files, 0) AS source_files, coalesce(t_files, 0) AS target_files
FROM (SELECT coalesce(s.volume, t.volume) AS volume, coalesce(s.directory, t.directory) AS directory, coalesce(s.depth, t.depth) AS depth, s.files AS s_files, t.files AS t_files,
    s.content IS NOT DISTINCT FROM t.content AS same FROM ({_OF(_DEEP)}) s FULL OUTER JOIN ({_OF(_DEEP_COPY)}) t ON s.volume = t.volume AND s.directory = t.directory) d
WHERE NOT same AND (s_files IS NOT NULL AND t_files IS NOT NULL OR depth = 0
  OR (s_files IS NULL AND (volume, regexp_replace(directory, '/?[^/]*$', '')) IN (SELECT (volume, directory) FROM ({_OF(_DEEP)}) p))
  OR (t_files IS NULL AND (volume, regexp_replace(directory, '/?[^/]*$', '')) IN (SELECT (volume, directory) FROM ({_OF(_DEEP_COPY)}) p)))""",
)
def _(inputs):
    made = lambda text: inputs.spark.sql(text, documents=inputs("documents"))
    digests = [files.directory_digests(made(t), keys=["volume"]) for t in (_DEEP, _DEEP_COPY)]
    return files.directory_differences(*digests, keys=["volume"])


# Files of a few contents each, so that a content is missing and extra several times.
_MOVED_FROM = "SELECT source AS volume, concat(lang, '/', doc_id, '.txt') AS relpath, md5(concat(doc_id % 40)) AS content_hash, doc_id FROM {documents}"
_MOVED_TO = """SELECT source AS volume, CASE WHEN doc_id % 6 = 1 THEN concat('moved/', doc_id, '.txt') WHEN doc_id % 6 = 2 THEN concat(lang, '/x', doc_id) ELSE concat(lang, '/', doc_id, '.txt') END AS relpath,
  md5(concat(CASE WHEN doc_id % 6 = 2 THEN doc_id % 60 WHEN doc_id % 11 = 5 THEN -1 ELSE doc_id % 40 END)) AS content_hash, doc_id FROM {documents} WHERE doc_id % 13 <> 4"""
_BETWEEN = f"""SELECT coalesce(s.volume, t.volume) AS volume, coalesce(s.relpath, t.relpath) AS relpath, coalesce(s.content_hash, t.content_hash) AS content,
  CASE WHEN t.relpath IS NULL THEN 'missing' WHEN s.relpath IS NULL THEN 'extra' ELSE 'mismatch' END AS difference
FROM ({_MOVED_FROM}) s FULL OUTER JOIN ({_MOVED_TO}) t ON s.volume = t.volume AND s.relpath = t.relpath WHERE s.content_hash IS DISTINCT FROM t.content_hash"""
_NUMBERED = f"SELECT *, row_number() OVER (PARTITION BY volume, content, difference ORDER BY md5(relpath), relpath) AS i FROM ({_BETWEEN}) WHERE difference <> 'mismatch'"


@query(
    "differences_with_moves",
    f"""SELECT coalesce(m.volume, e.volume) AS volume, coalesce(m.relpath, e.relpath) AS relpath, CASE WHEN e.relpath IS NULL THEN 'missing' WHEN m.relpath IS NULL THEN 'extra' ELSE 'moved' END AS difference,
  CASE WHEN m.relpath IS NOT NULL THEN e.relpath END AS moved_to
FROM (SELECT * FROM ({_NUMBERED}) WHERE difference = 'missing') m FULL OUTER JOIN (SELECT * FROM ({_NUMBERED}) WHERE difference = 'extra') e USING (volume, content, i)
UNION ALL SELECT volume, relpath, difference, NULL FROM ({_BETWEEN}) WHERE difference = 'mismatch'""",
)
def _(inputs):
    made = lambda text: inputs.spark.sql(text, documents=inputs("documents"))
    return files.differences_with_moves(made(_MOVED_FROM), made(_MOVED_TO), keys=["volume"])


# Ranges of 1000 bytes, so that longer documents have several.
_RANGED = "SELECT 'source=' || source AS tree, count(*) AS files, CAST(sum(greatest(ceil((octet_length(encode(text)) + 1) / 1000), 1)) AS BIGINT) AS ranges, TRUE AS whole_crc FROM {documents} GROUP BY source"


def _listed(inputs):
    return listings.list_trees(_trees(inputs, "root"), keys=["tree"]).filter(F.col("relpath").endswith(".txt"))


def _contents(listed):
    """The whole content of each listed file: read by many files a task, where Spark's file source plans a task for a few files."""
    open_path = listings.path_opener(listings.is_local(listed.sparkSession))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                filesystem, inner = open_path(row.pop("path"))
                with filesystem.open_input_stream(inner) as file:
                    rows.append({**row, "content": file.read()})
                size += len(rows[-1]["content"])
                if size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    import pyarrow as pa

    schema = pa.schema({"tree": pa.string(), "relpath": pa.string(), "content": pa.binary()})
    tasks = max(16, -(-listed.count() // FILES_PER_TASK))
    return listed.select("tree", "relpath", "path").repartition(tasks, "tree", "relpath").mapInArrow(read, "tree string, relpath string, content binary")


@query("range_digests", _RANGED)
def _(inputs):
    listed = _listed(inputs).checkpoint()
    found = ranges.combine_digests(ranges.range_digests(listed, keys=["tree"], range_bytes=1000, partitions=16), keys=["tree"])
    whole = _contents(listed).select("tree", "relpath", F.crc32("content").alias("whole"))
    rows = found.join(whole, ["tree", "relpath"])
    return _named(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("files"), F.sum("ranges").alias("ranges"), F.bool_and(F.col("whole") == F.col("crc32")).alias("whole_crc")))


@query("copy_by_ranges", f"SELECT tree, files, ranges, ranges AS copied_ranges, whole_crc, TRUE AS same_bytes FROM ({_RANGED}) r")
def _(inputs):
    listed, target = _listed(inputs).checkpoint(), scratch_path(inputs.spark, "ranges")
    pairs = listed.select("tree", "relpath", "size", F.col("path").alias("src"), F.concat_ws("/", F.lit(target), "tree", "relpath").alias("dst"))
    copied = ranges.copy_by_ranges(pairs, keys=["tree"], range_bytes=1000, partitions=16)
    digests = lambda rows: ranges.combine_digests(ranges.range_digests(rows, keys=["tree"], range_bytes=4096, partitions=16), keys=["tree"]).select("tree", "relpath", "crc32", "tree_hash")
    there = digests(pairs.select("tree", "relpath", "size", F.col("dst").alias("path"))).withColumnsRenamed({"crc32": "there", "tree_hash": "there_hash"})
    rows = copied.join(there, ["tree", "relpath"]).join(digests(listed).drop("crc32"), ["tree", "relpath"])
    return _named(rows.groupBy("tree").agg(
        F.count(F.lit(1)).alias("files"), F.sum("ranges").alias("ranges"), F.sum("copied_ranges").alias("copied_ranges"),
        F.bool_and(F.col("crc32") == F.col("there")).alias("whole_crc"), F.bool_and(F.col("tree_hash") == F.col("there_hash")).alias("same_bytes"),
    ))
