"""Small literal inputs."""

# fixed values: fixture rows, as given (sensor id, epoch seconds, value; words)

SENSOR = """sensor_1,1549044122,10
sensor_1,1549044123,20
sensor_1,1549044124,30
sensor_2,1549044125,40
sensor_1,1549044126,50
sensor_2,1549044127,60
sensor_1,1549044128,70
sensor_3,1549044129,80
sensor_3,1549044130,90
sensor_1,1549044115,10"""

SENSOR_CEP = """sensor_1,1549044115,10
sensor_1,1549044119,10
sensor_1,1549044122,10
sensor_2,1549044123,20
sensor_3,1549044124,30
sensor_1,1549044124,30
sensor_1,1549044127,30"""

WORDS = """hello dawn hello word
dawn hello man
do you like beijing"""


def sensor_df(spark, text=SENSOR):
    from pyspark.sql import functions as F
    rows = [(a, int(b), int(c), i) for i, (a, b, c) in
            enumerate(line.split(",") for line in text.splitlines())]
    df = spark.createDataFrame(rows, "id string, ts bigint, vc int, seq bigint")
    return df.withColumn("et", F.timestamp_seconds("ts"))
