"""The headers of the exports and the canonical names they get."""

HELPDESK_DROPPED = (
    "TITULO", "TIPO_INCIDENTE", "APROBRACION", "ASIG_PROVEE", "PRIORIDAD",
    "TIEMPO_ATENDER_SERVICIO", "TIEMPO_ESPERA", "TIEMPO_POSEER_EXCEDIDO", "TIEMPO_SOLUCION",
    "ULTIMA_ACTUALIZACION", "ESTADO",
)
HELPDESK_NAMES = {
    "id": "numero_caso",
    "TIPO": "tipo_de_caso",
    "SOLICITANTE": "usuariofinal",
    "ASIGANADO_A": "responsable",
    "CATEGORIA": "servicio",
    "FECHA_APERTURA": "fecha_creacion",
    "TIEMPO_ADUEÑARSE": "fecha_atencion",
    "FECHA_SOLUCION": "fecha_solucion",
    "TIEMPO_SOLUCION.1": "tiempoTranscurrido",
    "TIEMPO_RESOLVER_EXCEDIO": "CUMPLE_ANS",
}
REQUEST_NAMES = {
    "Número de solicitud": "numero_caso",
    "Fecha de creación": "fecha_creacion",
    "Fecha de modificación": "fecha_atencion",
    "(No modificar) Fecha de modificación": "fecha_solucion",
    "Autor": "usuariofinal",
    "Tipo de Requerimiento": "servicio",
    "Usuario que Gestiona": "responsable",
}
# both spellings of the case number; where both attention headers occur the first one counts
SUITE_CASE_NAMES = {
    "NúMERO DE CASO": "numero_caso",
    "NÚMERO DE CASO": "numero_caso",
    "TIPO DE CASO": "tipo_de_caso",
    "USUARIO FINAL": "usuariofinal",
    "ESPECIALISTA": "responsable",
    "SERVICIO": "servicio",
    "FECHA CREACIÓN": "fecha_creacion",
    "FECHA ATENCIÓN": "fecha_atencion",
    "FECHA  ESTIMADA ATENCIÓN": "fecha_atencion",
    "FECHA SOLUCIÓN": "fecha_solucion",
    "TIEMPO TRANSCURRIDO": "tiempoTranscurrido",
    "CUMPLIMIENTO ANS": "CUMPLE_ANS",
    "ORIGEN CASO": "origen_caso",
    "PROYECTO": "proyecto",
    "LOGIN RESPONSABLE": "username_resp",
    "LOGIN USUARIO FINAL": "username_ufinal",
}
TASK_NAMES = {
    "NUMERO DE LA TAREA": "numero_caso",
    "TIPO DE CASO": "tipo_de_caso",
    "AUTOR DE LA TAREA": "usuariofinal",
    "SERVICIO": "servicio",
    "RESPONSABLE TAREA": "responsable",
    "FECHA DE REGISTRO CASO": "fecha_creacion",
    "FECHA INICIO TAREA": "fecha_atencion",
    "FECHA FIN REAL TAREA": "fecha_solucion",
    "ORIGEN CASO": "origen_caso",
    "PROYECTO": "proyecto",
    "LOGIN RESPONSABLE TAREA": "username_resp",
    "LOGIN AUTOR TAREA": "username_ufinal",
}
TASK_DROPPED = (
    "NOMBRE TAREA", "DESCRIPCION TAREA", "FECHA FIN ESTIMADA TAREA", "PROGRESO TAREA %",
    "TIEMPO ESTIMADO TAREA",
)
TASK_REAL_TIME = "TIEMPO REAL TAREA"
EXTENDED_CASE_NAMES = {
    "NúMERO DE CASO": "numero_caso",
    "NÚMERO DE CASO": "numero_caso",
    "TIPO DE CASO": "tipo_de_caso",
    "USUARIO FINAL": "usuariofinal",
    "ESPECIALISTA": "responsable",
    "SERVICIO": "servicio",
    "FECHA DE REGISTRO": "fecha_creacion",
    "FECHA ATENCIÓN REAL": "fecha_atencion",
    "FECHA SOLUCIÓN REAL": "fecha_solucion",
    "FECHA ESTIMADA ATENCION": "fecha_estimada_atencion",
    "TIEMPO TRANSCURRIDO": "tiempoTranscurrido",
    "CUMPLIMIENTO ANS": "CUMPLE_ANS",
    "ORIGEN CASO": "origen_caso",
    "PROYECTO": "proyecto",
    "LOGIN RESPONSABLE": "username_resp",
    "LOGIN USUARIO FINAL": "username_ufinal",
    "ESTADO": "estado",
    "RAZON": "razon",
    "GRUPO ESPECIALISTA": "grupo_especialista",
    "PRIORIDAD": "prioridad",
    "SERVICIO AGROS": "servicio_agros",
    "UBICACION": "ubicacion",
}
EXTENDED_DROPPED = ("AUTOR DEL CASO", "FECHA ESTIMADA SOLUCION", "PROGRESO %", "ASUNTO")

CASE_DATES = ("fecha_creacion", "fecha_atencion", "fecha_solucion")
USERNAMES = ("username_ufinal", "username_resp")
