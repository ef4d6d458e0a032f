"""Java classes of this package as functions of Spark.

The driver compiles a source file with the compiler that Spark has for its own generated code, so no other
tool is needed, and adds the classes as a jar that executors fetch like any other.
"""

from __future__ import annotations

import hashlib
import os
import pkgutil
import tempfile
import zipfile
from typing import Any

from pyspark.sql import SparkSession

_compiled: dict[tuple[Any, str], tuple[Any, str]] = {}
_sent: set[tuple[str, str]] = set()


def _classes(spark: SparkSession, source: str) -> tuple[Any, str]:
    """Class loader of the compiled source, and the path of its jar on the driver."""
    jvm = spark.sparkContext._jvm
    key = spark.sparkContext._gateway, source
    if key not in _compiled:
        text = pkgutil.get_data(__package__, source).decode()
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(text)
        name = f"{source.partition('.')[0]}-{hashlib.sha256(text.encode()).hexdigest()[:16]}.jar"
        path = os.path.join(tempfile.mkdtemp(), name)
        with zipfile.ZipFile(path, "w") as jar:
            codes = compiler.getBytecodes()
            for one in codes:
                jar.writestr(f"{one.replace('.', '/')}.class", codes[one])
        _compiled[key] = compiler.getClassLoader(), path
    return _compiled[key]


def register(spark: SparkSession, source: str, functions: dict[str, tuple]) -> None:
    """Registers functions of a source file of this package: name to class, type of the result, arguments of the class."""
    sc = spark.sparkContext
    loader, jar = _classes(spark, source)
    if (sc.applicationId, jar) not in _sent:
        sc._jsc.sc().addJar(jar)
        _sent.add((sc.applicationId, jar))
    for name, (made, result, *given) in functions.items():
        arguments = sc._gateway.new_array(sc._jvm.java.lang.Object, len(given))
        for i, one in enumerate(given):
            arguments[i] = one
        function = loader.loadClass(made).getDeclaredConstructors()[0].newInstance(arguments)
        spark._jsparkSession.udf().register(name, function, sc._jvm.org.apache.spark.sql.types.DataType.fromDDL(result))
