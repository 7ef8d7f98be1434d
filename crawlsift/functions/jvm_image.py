"""Spark's own image decoder as a column function.

Spark decodes images in the JVM, but only its file source calls that code. A few lines of Java
call it for a column; they are compiled by the JDK that runs the driver and shipped to the
executors as a jar.
"""

from __future__ import annotations

import os
import subprocess
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from crawlsift.functions.image import IMAGE

_NAME = "crawlsift_decode_image"
_CLASS = "crawlsift.DecodeImage"
_SOURCE = """
package crawlsift;

import org.apache.spark.ml.image.ImageSchema$;
import org.apache.spark.sql.Row;
import org.apache.spark.sql.RowFactory;
import org.apache.spark.sql.api.java.UDF1;

/** Image bytes to (height, width, 3, RGB data); null where they do not decode. */
public class DecodeImage implements UDF1<byte[], Row> {
  // The bytes are in memory: without this the decoder copies each image to a file of its own.
  static { javax.imageio.ImageIO.setUseCache(false); }

  public Row call(byte[] bytes) {
    if (bytes == null || bytes.length == 0) return null;
    scala.Option<Row> found = ImageSchema$.MODULE$.decode("", bytes);
    if (found.isEmpty()) return null;
    Row image = found.get().getStruct(0);
    int height = image.getInt(1), width = image.getInt(2), channels = image.getInt(3);
    byte[] bgr = (byte[]) image.get(5);
    byte[] rgb = new byte[height * width * 3];
    for (int i = 0, from = 0; i < rgb.length; i += 3, from += channels) {
      rgb[i] = bgr[channels == 1 ? from : from + 2];
      rgb[i + 1] = bgr[channels == 1 ? from : from + 1];
      rgb[i + 2] = bgr[from];
    }
    return RowFactory.create(height, width, 3, rgb);
  }
}
"""
_ready: dict[str, bool] = {}


def _compile(spark: SparkSession) -> str | None:
    """Path of a jar with the class; None where the driver runs without a compiler."""
    system = spark.sparkContext._jvm.java.lang.System
    javac = os.path.join(system.getProperty("java.home"), "bin", "javac")
    if not os.path.exists(javac):
        return None
    folder = tempfile.mkdtemp(prefix="crawlsift-jar-")  # read by the driver only
    source = os.path.join(folder, "DecodeImage.java")
    with open(source, "w") as file:
        file.write(_SOURCE)
    classes = system.getProperty("java.class.path")
    subprocess.run([javac, "-proc:none", "-cp", classes, "-d", folder, source], check=True, capture_output=True)
    jar = os.path.join(folder, "crawlsift-image.jar")
    with zipfile.ZipFile(jar, "w") as archive:
        archive.write(os.path.join(folder, "crawlsift", "DecodeImage.class"), "crawlsift/DecodeImage.class")
    return jar


def jvm_decoder(spark: SparkSession) -> Callable[[Column], Column] | None:
    """Column function from image bytes to a packed RGB image, or None without a compiler."""
    app = spark.sparkContext.applicationId
    if app not in _ready:
        jar = _compile(spark)
        _ready[app] = jar is not None
        if jar is not None:
            spark.sql(f"ADD JAR '{jar}'")
    if not _ready[app]:
        return None
    spark.udf.registerJavaFunction(_NAME, _CLASS, IMAGE)
    return lambda payload: F.call_function(_NAME, payload)
