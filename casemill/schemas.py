"""Canonical tables: column order and types."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "numero_caso": T.LongType(),
    "fecha_creacion": T.TimestampNTZType(),
    "fecha_atencion": T.TimestampNTZType(),
    "fecha_solucion": T.TimestampNTZType(),
    "fecha_estimada_atencion": T.TimestampNTZType(),
    "tiempoTranscurrido": T.LongType(),
    "tiempoTranscurridoAtencion": T.LongType(),
}

# The column contracts of the three report tables.
INDICATORS = (
    "numero_caso", "tipo_de_caso", "usuariofinal", "responsable", "servicio",
    "fecha_creacion", "fecha_atencion", "fecha_solucion", "tiempoTranscurrido",
    "CUMPLE_ANS", "origen_caso", "proyecto", "username_resp", "username_ufinal",
)
PROVISIONAL = (
    "tipo_de_caso", "origen_caso", "proyecto", "numero_caso", "prioridad", "servicio",
    "grupo_especialista", "responsable", "username_resp", "usuariofinal",
    "username_ufinal", "estado", "razon", "fecha_creacion", "fecha_estimada_atencion",
    "fecha_atencion", "fecha_solucion", "tiempoTranscurrido", "CUMPLE_ANS", "ubicacion",
    "servicio_agros", "tiempoTranscurridoAtencion", "CUMPLE_ANS_ATENCION", "estado_caso",
)
TASKS = (
    "tipo_de_caso", "origen_caso", "proyecto", "CASO RELACIONADO", "numero_caso",
    "servicio", "responsable", "username_resp", "usuariofinal", "username_ufinal",
    "ESTADO TAREA", "fecha_creacion", "fecha_atencion", "fecha_solucion",
    "tiempoTranscurrido", "CUMPLE_ANS",
)


def _struct(columns, text=()) -> T.StructType:
    return T.StructType(
        [
            T.StructField(c, T.StringType() if c in text else _TYPES.get(c, T.StringType()))
            for c in columns
        ]
    )


def indicators_schema() -> T.StructType:
    """A fresh copy of the consolidated table's schema."""
    return _struct(INDICATORS)


def provisional_schema() -> T.StructType:
    """The open-and-closed report; case numbers stay text there."""
    return _struct(PROVISIONAL, text=("numero_caso",))


def tasks_schema() -> T.StructType:
    """The task report; case numbers stay text there."""
    return _struct(TASKS, text=("numero_caso",))


def master_schema() -> T.StructType:
    """The identity master."""
    return _struct(("NombreCompleto", "cedula", "username"))
