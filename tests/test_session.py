"""Session sizing and scratch folders."""

from changelake.session import MAX_SHUFFLE_PARTITIONS, cluster_conf, scratch_dir


def test_cluster_conf_bounds():
    big = cluster_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 102_400
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(10 * 2**50, 8000)["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    assert int(cluster_conf(2**20, 64)["spark.sql.shuffle.partitions"]) == 128   # two per core



def test_scratch_dirs_are_fresh_and_under_the_checkpoint_folder(spark):
    a = scratch_dir(spark, "x", fresh=True)
    b = scratch_dir(spark, "x", fresh=True)
    root = scratch_dir(spark)
    assert a != b and a.startswith(root) and b.startswith(root)
